"""Near-duplicates by an LSH forest over MinHash signatures.

Distinct shingle sets get a signature of 128 minima, a byte each. The forest has 16 trees: tree t orders
the sets by the signature read from its 8 t-th byte on, around the end. Sets that share the first four bytes
of an order are a region; a small region is compared whole, and in a crowded one the order itself goes
deeper: a set meets the 256 to 512 next to it on either side, which are those of the longest common
prefixes. Pairs that agree in enough of the signature are candidates, and candidates are confirmed on
the full sets.

A search goes in rounds. At first a set names its nearest candidate of a window only; confirmed links
join components, and windows where a set had more candidates are searched again for pairs that are still
apart, with eight times as many a set, until none is left. Each set has an odd sketch, too: bits that each of its
shingles flips. Where two sketches differ the sets differ, so a pair that differs in more bits than a link
allows is no candidate; that excludes no link. So copies by the thousand give links by the thousand, and
every candidate between components is tested in the end.

A pair at a similarity of 0.85 misses all regions with a chance of about 7e-6 and the comparison of
signatures with about 2e-6; only in crowded regions can more be lost.

Defined cases: texts without words and null texts have an empty set and are linked with nothing, not even
with each other; a component is named by its smallest doc_id, rows without one by null if no other is
there (``kept`` compares null with null as equal); rows that repeat an id are documents of their own;
an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from wattloom.llm.common import lowered, slices, table
from wattloom.llm.graph import components
from wattloom.session import written

#: Words of a shingle and the similarity of a link, in percent.
SHINGLE, PERCENT = 3, 85
#: Bytes of a signature, bytes that part the trees' starts, and bytes that a region shares.
MINIMA, STRIDE, SHARED = 128, 8, 4
TREES = MINIMA // STRIDE
#: Sets that are compared with each other in one window of an order; windows overlap by half.
WINDOW = 512
#: Equal bytes that make a candidate: 0.85 gives 109 on average, with a deviation of 4.
ALIKE = 90
#: Rows that name texts to fetch are broadcast up to so many (about 8 MB); beyond that they are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: Words remembered by a worker, bytes of text split at once, shingles hashed at once.
REMEMBERED, PIECE, STEP = 300_000, 1 << 20, 4096

_RANDOM = np.random.default_rng(20240611)
_TIMES = _RANDOM.integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RANDOM.integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2)
_FACTORS = _RANDOM.integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxh64_intdigest(word, 11)
        return found


_WORDS = _Hashes()


def _word_hashes(data: bytes) -> np.ndarray:
    parts, at = [], 0
    while at < len(data):
        gap = _SPACE.search(data, at + PIECE)
        end = gap.start() if gap else len(data)
        words = data[at:end].split()
        parts.append(np.fromiter(map(_WORDS.__getitem__, words), dtype=np.uint64, count=len(words)))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)


def shingles(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of the distinct shingles, rising; fewer words than ``size`` are one shingle."""
    words = _word_hashes(lowered(text or b""))
    if not len(words):
        return words
    span = min(size, len(words))
    found = np.full(len(words) - span + 1, np.uint64(span), dtype=np.uint64)
    for k in range(span):
        found = (found + words[k : len(words) - span + 1 + k]) * _FACTORS[k]
    return np.unique(found ^ (found >> np.uint64(31)))


def signature(found: np.ndarray) -> bytes:
    """A byte of each of the minima over a set's hashes."""
    least = np.full(MINIMA, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(found), STEP):
        np.minimum(least, (found[at : at + STEP, None] * _TIMES + _PLUS).min(axis=0), out=least)
    return ((least * _FACTORS[-1]) >> np.uint64(56)).astype(np.uint8).tobytes()


def odd_sketch(found: np.ndarray) -> bytes:
    """Two to four bits a shingle, at least 512: a bit is 1 if an odd number of the set's hashes fall on it."""
    size = max(512, 1 << (2 * len(found) - 1).bit_length())
    flips = np.bincount((found & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(flips.astype(np.uint8)).tobytes()


def prints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, n (shingles), two sums that name the set, its signature and odd sketch, and a hash of the text."""
    rows = docs.select(F.col("`doc_id`").alias("doc_id"), F.xxhash64(F.col("`text`")).alias("text_hash"), F.col("`text`").cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            numbers, signatures, sketches = np.zeros((3, part.num_rows), dtype=np.uint64), [], []
            for i, text in enumerate(part.column("text")):
                found = shingles(text.as_py(), size)
                mixed = found * _FACTORS[-2]
                numbers[:, i] = len(found), found.sum(dtype=np.uint64), (mixed ^ (mixed >> np.uint64(29))).sum(dtype=np.uint64)
                signatures.append(signature(found) if len(found) else None)
                sketches.append(odd_sketch(found) if len(found) else None)
            columns = [part.column("doc_id"), part.column("text_hash"), *map(pa.array, numbers.view(np.int64)), pa.array(signatures, pa.binary()), pa.array(sketches, pa.binary())]
            yield pa.record_batch(columns, names=["doc_id", "text_hash", "n", "sum", "mixed", "signature", "sketch"])

    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, n long, sum long, mixed long, signature binary, sketch binary")


def windows(classes: DataFrame) -> DataFrame:
    """(window, id, order, n, sketch): the sets to compare. Sets that share a region with no other are in none."""
    order = f"concat(substring(signature, 1 + {STRIDE} * tree), substring(signature, 1, {STRIDE} * tree))"
    trees = classes.select("id", "signature", F.expr(f"explode(sequence(0, {TREES - 1})) as tree"))
    keyed = trees.select("id", "tree", F.expr(f"substring({order}, 1, {SHARED}) as region"))
    shared = keyed.groupBy("tree", "region").count().where("count > 1")
    placed = written(keyed.join(shared, ["tree", "region"]).select("id", "tree", "count"), "regions")
    rows = placed.join(classes.select("id", "signature", "n", "sketch"), "id").select("tree", F.expr(f"{order} as order"), "id", "n", "sketch", "count")
    by = ["tree", "order", "id"]
    half = WINDOW // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows come in order: a region's n-th row is in the windows of its half and of the half before."""
        base, before, now = TaskContext.get().partitionId() << 40, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            trees, ids = batch.column("tree").to_numpy(), batch.column("id").to_numpy()
            orders = np.frombuffer(b"".join(o.as_py() for o in batch.column("order")), dtype=np.uint8).reshape(-1, MINIMA)
            key = np.column_stack([trees.astype(np.int64), orders[:, :SHARED].astype(np.int64)])
            first = np.r_[now is None or (key[0] != now).any(), (key[1:] != key[:-1]).any(axis=1)]
            starts = np.flatnonzero(first)
            if not first[0]:
                starts = np.r_[0, starts]
            sizes = np.diff(np.r_[starts, len(ids)])
            sizes[0] += 0 if first[0] else before
            base += (before - 1) // half + 1 if first[0] and before else 0
            bases = base + np.r_[0, np.cumsum((sizes[:-1] - 1) // half + 1)]
            of = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(ids)]))
            nth = np.arange(len(ids)) - starts[of] + np.where((of == 0) & (not first[0]), before, 0)
            own, last = nth // half, np.maximum((batch.column("count").to_numpy() - 1) // half - 1, 0)
            base, before, now = bases[-1], int(sizes[-1]), key[-1]
            there, also = np.flatnonzero(own <= last), np.flatnonzero(own > 0)  # the last half has no window of its own
            rows = np.r_[there, also]
            window = (bases[of] + own)[rows] - np.r_[np.zeros(len(there), dtype=np.int64), np.ones(len(also), dtype=np.int64)]
            taken = [batch.column(c).take(pa.array(rows)) for c in ("id", "order", "n", "sketch")]
            yield pa.record_batch([pa.array(window), *taken], names=["window", "id", "order", "n", "sketch"])

    return rows.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(run, "window long, id long, order binary, n long, sketch binary")


class Sketches:
    """The odd sketches of a window, folded to the shorter of two where they differ in size."""

    def __init__(self, sketches: list[bytes]):
        self.bits, self.sizes, self.folded = sketches, np.array([len(s) for s in sketches]), {}

    def _at(self, size: int) -> np.ndarray:
        if size not in self.folded:
            rows = np.zeros((len(self.bits), size // 8), dtype=np.uint64)
            for i in np.flatnonzero(self.sizes >= size):
                rows[i] = np.bitwise_xor.reduce(np.frombuffer(self.bits[i], dtype=np.uint64).reshape(-1, size // 8), axis=0)
            self.folded[size] = rows
        return self.folded[size]

    def apart(self, i: int, others: np.ndarray) -> np.ndarray:
        """At least so many shingles are in one set only, of row i and each of the others."""
        out, least = np.zeros(len(others), dtype=np.int64), np.minimum(self.sizes[others], self.sizes[i])
        for size in np.unique(least):
            rows, these = self._at(int(size)), least == size
            out[these] = np.bitwise_count(rows[others[these]] ^ rows[i]).sum(axis=1, dtype=np.int64)
        return out


def alike(orders: np.ndarray, labels: np.ndarray, n: np.ndarray, sketches: Sketches, most: int, percent: int = PERCENT) -> tuple[list[tuple[int, int]], bool]:
    """Each row's ``most`` nearest candidates of another label, as pairs of places, and if a row had more; ``n`` are the sets' sizes."""
    pairs, more = set(), False
    for at in range(0, len(orders), 64):
        these = slice(at, at + 64)
        equal = np.count_nonzero(orders[these, None, :] == orders[None, :, :], axis=2)
        fits = (equal >= ALIKE) & (labels[these, None] != labels[None, :])
        for i in np.flatnonzero(fits.any(axis=1)):
            near = np.flatnonzero(fits[i])
            near = near[(100 + percent) * np.abs(n[near] - n[at + i]) <= (100 - percent) * (n[near] + n[at + i])]
            near = near[(100 + percent) * sketches.apart(at + i, near) <= (100 - percent) * (n[near] + n[at + i])]
            if len(near) > most:
                more = True
                near = near[np.lexsort((np.abs(near - at - i), -equal[i, near]))[:most]]
            pairs.update((min(at + i, j), max(at + i, j)) for j in near.tolist())
    return sorted(pairs), more


def candidates(found: DataFrame, most: int, percent: int) -> DataFrame:
    """(window, a, b) of the candidates named in windows of (window, id, order, label, n, sketch); a row without a and b: there are more."""

    def search(window: pa.Table) -> pa.Table:
        window = window.sort_by([("order", "ascending"), ("id", "ascending")])
        ids, labels, n = [window.column(c).to_numpy() for c in ("id", "label", "n")]
        if (labels == labels[0]).all():
            pairs, more = [], False
        else:
            orders = np.frombuffer(b"".join(o.as_py() for o in window.column("order")), dtype=np.uint8).reshape(-1, MINIMA)
            pairs, more = alike(orders, labels, n, Sketches(window.column("sketch").to_pylist()), most, percent)
        a, b = [int(min(ids[i], ids[j])) for i, j in pairs], [int(max(ids[i], ids[j])) for i, j in pairs]
        of = pa.array([window.column("window")[0].as_py()] * (len(a) + more), pa.int64())
        return pa.table({"window": of, "a": pa.array([*a, *[None] * more], pa.int64()), "b": pa.array([*b, *[None] * more], pa.int64())})

    return found.groupBy("window").applyInArrow(search, "window long, a long, b long")


def sets(docs: DataFrame, seen: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """(id, shingles) of the given classes, from one text of each, read again."""
    first = seen.groupBy("text_hash").agg(F.min("doc_id").alias("doc_id"))
    named = written(first.join(classes.select("id", "text_hash"), "text_hash"), "wanted")
    few = F.broadcast(named) if named.count() <= BROADCAST_ROWS else named
    texts = docs.select(F.col("`doc_id`").alias("of"), F.xxhash64(F.col("`text`")).alias("hash"), F.col("`text`").cast("binary").alias("text"))
    texts = texts.join(few, (F.col("hash") == F.col("text_hash")) & F.col("of").eqNullSafe(F.col("doc_id"))).select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [shingles(t.as_py(), size).view(np.int64) for t in part.column("text")]
            yield pa.record_batch([part.column("id"), pa.array(found, pa.list_(pa.int64()))], names=["id", "shingles"])

    return texts.mapInArrow(run, "id long, shingles array<long>").dropDuplicates(["id"])  # repeated rows bring their text again


def confirmed(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    left = known.select(F.col("id").alias("a"), F.col("shingles").alias("set_a"))
    right = known.select(F.col("id").alias("b"), F.col("shingles").alias("set_b"))
    both = pairs.join(left, "a").join(right, "b").selectExpr("a", "b", "size(set_a) + size(set_b) as total", "size(array_intersect(set_a, set_b)) as both")
    return both.where(f"100L * both >= {percent}L * (total - both)").select("a", "b")


def links(docs: DataFrame, seen: DataFrame, classes: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Confirmed pairs of classes that join every component, and (node, root) of the components."""
    spark = docs.sparkSession
    found = written(windows(classes), "windows")
    sure = spark.createDataFrame([], "a long, b long")
    tested, roots, most = sure, spark.createDataFrame([], "node long, root long"), 1
    searched = found.withColumn("label", F.col("id"))
    while True:
        named = written(candidates(searched, most, percent), "candidates")
        fresh = named.where("a is not null").select("a", "b").distinct()
        fresh = written(fresh.join(tested, ["a", "b"], "left_anti"), "fresh")
        if most == 1:  # whoever has a candidate names one in the first round
            ids = fresh.select(F.explode(F.array("a", "b")).alias("id")).distinct()
            known = written(sets(docs, seen, classes.join(ids, "id", "left_semi"), size), "sets")
        joined = written(confirmed(fresh, known, percent), "links")
        if joined.take(1):
            sure = sure.unionByName(joined)
            roots = components(sure)
        open_windows = written(named.where("a is null").select("window"), "open")
        if not open_windows.take(1):
            return sure, roots
        tested, most = tested.unionByName(fresh), 8 * most
        searched = found.join(open_windows, "window", "left_semi").join(roots.withColumnRenamed("node", "id"), "id", "left")
        searched = searched.select(*found.columns, F.coalesce("root", "id").alias("label"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``."""
    seen = written(prints(docs, size), "prints")
    same = ["n", "sum", "mixed", "signature", "sketch"]
    classes = seen.where("n > 0").groupBy(*same).agg(F.min("doc_id").alias("least"), F.min("text_hash").alias("text_hash"))
    classes = written(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    _, roots = links(docs, seen, classes, size, percent)
    rooted = classes.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    rooted = written(rooted.select("n", "sum", "mixed", "least", "root"), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    placed = rooted.join(least, "root").select("n", "sum", "mixed", "component")
    rows = seen.select("doc_id", "n", "sum", "mixed").join(placed, ["n", "sum", "mixed"], "left")
    named = rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))
    return named.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op11_lsh_forest(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
