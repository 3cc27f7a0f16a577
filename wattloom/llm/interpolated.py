"""Language-model scores by deleted interpolation.

Maximum-likelihood estimates of all orders down to single tokens, and the uniform distribution, are
mixed. The mixture depends on how often the context was seen (one bucket an octave). Weights come
from expectation-maximisation on a part of the training documents whose counts are deleted from the
estimates meanwhile; the final estimates count all training documents.

Work moves as blocks: a task turns some megabytes of text into one row of token ids. A block asks for
the counts of its distinct n-grams, by 64-bit hash, dealt out by hash range; the range sums what all
blocks have and answers each. Frequent n-grams are thereby one entry a block, wherever they occur.

Defined cases: a null text is the closing token only; without training documents every estimate is
uniform over one token, and scores are 0; a table of any size has training documents to delete, unless
the ids of all of them hash alike, when weights stay equal; a null doc_id belongs to remainder 0; repeated rows score
alike and count each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from wattloom.llm.common import fold, lowered, narrowed, slices, table
from wattloom.session import written

ORDER = 2
#: One training document in so many has its counts deleted while weights are learned from it.
DELETED_SHARE = 32
#: Bytes of text in a block; tokens (of all blocks) a hash range answers for.
BLOCK_BYTES, RANGE_TOKENS = 8 << 20, 1 << 20
BUCKETS = 48
ROUNDS, SETTLED, LEAST_WEIGHT = 30, 1e-5, 1e-6
_CLOSING, _OPENING = xxh64_intdigest(b" closing"), xxh64_intdigest(b" opening")  # no word holds a space


def _squeezed(values: np.ndarray) -> bytes:
    """Small numbers, byte plane by byte plane."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _restored(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data, max_output_size=0) if data else b"", np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel()


def blocks(docs: DataFrame, trained: str, deleted: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Rows of (block, deleted, columns as arrays, tokens as array, ids, words).

    ``trained`` and ``deleted`` are boolean columns. Documents whose counts are deleted get blocks of their own.
    """
    columns = ("doc_id", trained, *extra)
    rows = narrowed(docs, *columns, deleted)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = "block long, deleted boolean, " + ", ".join(f"`{c}` array<{kinds[c]}>" for c in columns) + ", tokens array<int>, ids binary, words binary"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        for part in slices(batches, limit=BLOCK_BYTES):
            flags = part.column(deleted).to_numpy(zero_copy_only=False).astype(bool)
            for flag in (False, True):
                chosen = part.filter(pa.array(flags == flag))
                if not chosen.num_rows:
                    continue
                known: dict[bytes, int] = {b" closing": 0}
                ids, tokens = [], []
                for text in chosen.column("text"):
                    words = lowered(text.as_py() or b"").split()
                    for word in words:
                        if word not in known:
                            known[word] = len(known)
                    ids.append(np.fromiter(map(known.__getitem__, words), dtype=np.uint32, count=len(words)))
                    ids.append(np.zeros(1, dtype=np.uint32))
                    tokens.append(len(words) + 1)
                hashes = np.fromiter(map(xxh64_intdigest, known), dtype=np.uint64, count=len(known))
                values = [[block], [flag], *[pa.array([chosen.column(c).to_pylist()], pa.list_(chosen.column(c).type)) for c in columns]]
                values += [pa.array([tokens], pa.list_(pa.int32())), pa.array([_squeezed(np.concatenate(ids))], pa.binary()), pa.array([hashes.tobytes()], pa.binary())]
                yield pa.record_batch([pa.array(v) if isinstance(v, list) else v for v in values], names=["block", "deleted", *columns, "tokens", "ids", "words"])
                block += 1

    return rows.mapInArrow(encode, schema)


def _mixed(context: np.ndarray, last: np.ndarray) -> np.ndarray:
    x = (context * np.uint64(0x9E3779B97F4A7C15)) ^ (last + np.uint64(0x7F4A7C159E3779B9) + (context << np.uint64(6)) + (context >> np.uint64(2)))
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def grams(ids: bytes, words: bytes, tokens: np.ndarray, order: int) -> list[np.ndarray]:
    """Hash of the n-gram that ends at each token, for n = 1 .. order; before a text stands an opening mark."""
    word = np.frombuffer(words, np.uint64)[_restored(ids, "u4")]
    ends = np.cumsum(tokens)
    starts = ends - tokens
    found, history = [word], word
    opening = np.uint64(_OPENING)
    for n in range(2, order + 1):
        before = np.empty_like(history)
        before[1:] = history[:-1]
        # the (n-1)-gram that ends just before; at the start of a text it is all opening marks
        before[starts] = opening if n == 2 else _mixed(np.full(len(starts), opening), np.full(len(starts), opening))
        history = _mixed(before, word)
        found.append(history)
    return found


def requests(packed: DataFrame, order: int, ranges: int) -> DataFrame:
    """(order, range, block, deleted, keys, counts): a block's distinct n-grams and its own training counts."""
    bits = ranges.bit_length() - 1

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens = np.array(row["tokens"], dtype=np.int64)
                trained = np.repeat(np.array(row["trained"], dtype=bool), tokens)
                for n, keys in enumerate(grams(row["ids"], row["words"], tokens, order), 1):
                    distinct, at = np.unique(keys, return_inverse=True)
                    counts = np.bincount(at[trained], minlength=len(distinct)).astype(np.uint32)
                    edges = np.searchsorted(distinct >> np.uint64(64 - bits), np.arange(ranges + 1, dtype=np.uint64)) if bits else np.array([0, len(distinct)])
                    held = np.flatnonzero(np.diff(edges))
                    steps = [np.diff(distinct[edges[r] : edges[r + 1]], prepend=np.uint64(0)) for r in held]
                    yield pa.record_batch(
                        [pa.array([n] * len(held), pa.int32()), pa.array(held, pa.int32()), pa.array([row["block"]] * len(held), pa.int64()), pa.array([row["deleted"]] * len(held)), pa.array(map(_squeezed, steps), pa.binary()), pa.array([_squeezed(counts[edges[r] : edges[r + 1]]) for r in held], pa.binary())],
                        names=["n", "range", "block", "deleted", "keys", "counts"],
                    )

    return packed.select("block", "deleted", "trained", "tokens", "ids", "words").mapInArrow(ask, "n int, range int, block long, deleted boolean, keys binary, counts binary")


def _answer(group: pd.DataFrame) -> pd.DataFrame:
    """Sums one hash range over all blocks; a row goes back to each block, and one (block -1) tells the distinct n-grams."""
    keys = [np.cumsum(_restored(k, "u8"), dtype=np.uint64) for k in group["keys"]]
    sizes = [len(k) for k in keys]
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.concatenate([_restored(c, "u4") for c in group["counts"]]).astype(np.float64)
    gone = np.repeat(group["deleted"].to_numpy(dtype=bool), sizes)
    total = np.bincount(at, counts, len(distinct)).astype(np.uint64)
    kept = total - np.bincount(at[gone], counts[gone], len(distinct)).astype(np.uint64)
    out, start = [], 0
    for block, deleted, size in zip(group["block"], group["deleted"], sizes, strict=True):
        here = at[start : start + size]
        start += size
        out.append((block, _squeezed(total[here]), _squeezed(kept[here]) if deleted else None, 0, 0))
    out.append((-1, None, None, int((total > 0).sum()), int((kept > 0).sum())))
    told = pd.DataFrame(out, columns=["block", "total", "kept", "seen", "seen_kept"])
    told.insert(0, "n", int(group["n"].iloc[0]))
    told.insert(1, "range", int(group["range"].iloc[0]))
    return told


ANSWER = "n int, range int, block long, total binary, kept binary, seen long, seen_kept long"


def _estimates(ids: bytes, words: bytes, tokens: np.ndarray, answers: pd.DataFrame, column: str, n_tokens: int, n_docs: int, order: int):
    """For each token: its count, its estimates from the longest order down to single tokens, and its context's bucket."""
    starts = np.cumsum(tokens) - tokens
    context, estimates, single = None, [], None
    for n, keys in enumerate(grams(ids, words, tokens, order), 1):
        mine = answers[answers["n"] == n].sort_values("range")
        counts = np.concatenate([_restored(x, "u8") for x in mine[column]]).astype(np.float64)
        count = counts[np.unique(keys, return_inverse=True)[1]]
        if n == 1:
            single, estimates = count, [count / max(n_tokens, 1)]
            context = np.full(len(count), float(n_tokens))
        else:
            context = np.empty(len(count))
            context[1:] = below[:-1]
            context[starts] = n_docs
            estimates.insert(0, count / np.maximum(context, 1))
        below = count
    return single, np.array(estimates), np.minimum(np.log2(context + 1).astype(np.int64), BUCKETS - 1)


class Model:
    """Weights by context bucket (longest order first, uniform last) and the totals the estimates divide by."""

    def __init__(self, order: int, weights: np.ndarray, tokens: int, docs: int, distinct: int):
        self.order, self.weights, self.tokens, self.docs, self.distinct = order, weights, tokens, docs, distinct

    def plain(self) -> tuple:
        return self.order, self.weights, self.tokens, self.docs, self.distinct


def learn_weights(packed: DataFrame, answers: DataFrame, order: int, tokens: int, docs: int, distinct: int) -> np.ndarray:
    """Expectation-maximisation over the deleted documents; each round is one pass that sums expected counts by bucket."""

    def gather(block: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        if not len(block) or not len(told):
            return pd.DataFrame({"bucket": pd.Series(dtype="int32"), "estimates": pd.Series(dtype=object)})
        row = block.iloc[0]
        _, estimates, bucket = _estimates(row["ids"], row["words"], np.asarray(row["tokens"], dtype=np.int64), told, "kept", tokens, docs, order)
        return pd.DataFrame([(int(b), np.ascontiguousarray(estimates[:, bucket == b].T).tobytes()) for b in np.unique(bucket)], columns=["bucket", "estimates"])

    weights = np.full((BUCKETS, order + 1), 1 / (order + 1))
    kept = answers.where("kept is not null").groupBy("block")
    cases = written(packed.where("deleted").groupBy("block").cogroup(kept).applyInPandas(gather, "bucket int, estimates binary"), "cases")
    uniform, before = 1 / (distinct + 1), None
    for _ in range(ROUNDS):
        now = weights

        def expect(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            sums, likelihood = np.zeros((BUCKETS, order + 1)), np.zeros(BUCKETS)
            for batch in batches:
                for row in batch.to_pylist():
                    estimates = np.frombuffer(row["estimates"], np.float64).reshape(-1, order)
                    part = np.column_stack([estimates, np.full(len(estimates), uniform)]) * now[row["bucket"]]
                    whole = part.sum(axis=1)
                    sums[row["bucket"]] += (part / whole[:, None]).sum(axis=0)
                    likelihood[row["bucket"]] += np.log(whole).sum()
            held = np.flatnonzero(sums.sum(axis=1))
            yield pa.record_batch([pa.array(held, pa.int32()), pa.array(sums[held].tolist(), pa.list_(pa.float64())), pa.array(likelihood[held])], names=["bucket", "sums", "likelihood"])

        told = cases.mapInArrow(expect, "bucket int, sums array<double>, likelihood double")
        expected = told.groupBy("bucket").agg(F.array(*[F.sum(F.col("sums")[i]) for i in range(order + 1)]).alias("sums"), F.sum("likelihood").alias("likelihood")).collect()  # at most BUCKETS rows
        if not expected:
            break
        weights = weights.copy()
        for row in expected:
            share = np.maximum(np.array(row["sums"]) / sum(row["sums"]), LEAST_WEIGHT)
            weights[row["bucket"]] = share / share.sum()
        total = sum(r["likelihood"] for r in expected)
        if before is not None and total - before < SETTLED * abs(before):
            break
        before = total
    return _filled(weights, {r["bucket"] for r in expected})


def _filled(weights: np.ndarray, seen: set[int]) -> np.ndarray:
    """A bucket without deleted tokens takes the weights of the nearest bucket that has some, the lower one first."""
    for b in range(BUCKETS):
        if seen and b not in seen:
            weights[b] = weights[min(seen, key=lambda s: (abs(s - b), s))]
    return weights


def scores(docs: DataFrame, trained: str, order: int = ORDER, extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ``extra``, n_tokens, n_known, train_tokens, base_score and score of every row.

    ``trained`` names a boolean column: which rows the model learns from.
    """
    marked, part = docs.withColumn("trained", F.col(trained)), F.expr(f"pmod(xxhash64(doc_id, 'deleted'), {DELETED_SHARE})")
    parts = marked.where("trained").agg(F.min(part).alias("least"), F.max(part).alias("most")).first()
    several = parts["least"] != parts["most"]  # else nothing would be left to count; part 0 unless the table is tiny
    marked = marked.withColumn("_deleted", F.col("trained") & (part == parts["least"]) if several else F.lit(False))
    packed = written(blocks(marked, "trained", "_deleted", extra), "blocks")
    summed = packed.selectExpr("deleted", "explode(arrays_zip(trained, tokens)) as d").selectExpr("deleted", "d.trained", "d.tokens").groupBy("deleted", "trained").agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens")).collect()  # at most four rows
    n = {k: sum(r[k] for r in summed if r["trained"]) for k in ("docs", "tokens")}
    kept = {k: sum(r[k] for r in summed if r["trained"] and not r["deleted"]) for k in ("docs", "tokens")}
    everything = sum(r["tokens"] for r in summed)
    ranges = 1 << max(0, math.ceil(math.log2(max(1, everything / RANGE_TOKENS))))
    answers = written(requests(packed, order, ranges).groupBy("n", "range").applyInPandas(_answer, ANSWER), "answers")
    distinct = answers.where("block = -1 and n = 1").agg(F.sum("seen").alias("seen"), F.sum("seen_kept").alias("kept")).first()
    seen, seen_kept = int(distinct["seen"] or 0), int(distinct["kept"] or 0)
    weights = learn_weights(packed, answers, order, kept["tokens"], kept["docs"], seen_kept)
    if not n["tokens"]:
        weights[:, :order], weights[:, order] = 0, 1
    carried = ("doc_id", *extra)
    kinds = {f.name: f.dataType.elementType.simpleString() for f in packed.schema if f.name in carried}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in carried) + ", n_tokens long, n_known long, train_tokens long, base_score double, score double"
    n_tokens, n_docs = n["tokens"], n["docs"]

    def score(block: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        row = block.iloc[0]
        tokens = np.asarray(row["tokens"], dtype=np.int64)
        single, estimates, bucket = _estimates(row["ids"], row["words"], tokens, told, "total", n_tokens, n_docs, order)
        starts = np.cumsum(tokens) - tokens
        mixed = (weights[bucket, :order] * estimates.T).sum(axis=1) + weights[bucket, order] / (seen + 1)
        out = {c: row[c] for c in carried}
        out |= {"n_tokens": tokens, "n_known": np.add.reduceat((single > 0).astype(np.int64), starts), "train_tokens": n_tokens}
        out |= {"base_score": np.add.reduceat(np.log10((single + 1) / (n_tokens + seen + 1)), starts), "score": np.add.reduceat(np.log10(mixed), starts)}
        return pd.DataFrame(out)

    return packed.groupBy("block").cogroup(answers.where("block >= 0").groupBy("block")).applyInPandas(score, schema)


def op2_interpolated_lm(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(7) == 2).withColumn("learned", ~F.col("held_out"))
    return scores(docs, "learned", extra=("held_out",)).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
