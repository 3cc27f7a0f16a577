"""Alignment of two tokenizers' tokens, and how often the corpus links an id of one with an id of the other.

Divide and conquer at shared cuts: an interval of tokens is parted at a byte where tokens of both sides
end, found nearest its middle by bisection of the other side's ends, and both halves go on alike. An
interval without an inner shared cut is a group: all its tokens of one side are linked with all of the
other. All intervals of a slice of texts take a step at once, as arrays.

A pair of ids is counted once a document that links it. Documents are dealt in blocks of bounded text; a
block asks for the counts of its distinct pairs, so what is shuffled grows with the distinct pairs of
blocks, and hot pairs are one row a block. Only the best count of an id of the first side is broadcast, a
row an id of its vocabulary.

Defined cases: a text that is null, empty or not given back byte for byte by both tokenizers has no tokens,
zeros and the empty digest; a null doc_id is kept; repeated rows are documents of their own and each counts;
special tokens' strings are plain text; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import narrowed, slices, table
from wattloom.session import written

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text in a block; tokens probed one by one before an interval is searched in widening windows.
BLOCK_BYTES, PROBES = 8 << 20, 16
#: A larger group links distinct ids with their numbers instead of token by token.
LARGE_GROUP = 65_536
#: Tiktoken's pattern gives up on runs of white space several times as long; the slower library takes them.
LONG_SPACE = 65_536
_LONG_SPACE = re.compile(rf"\s{{{LONG_SPACE}}}")


def located(name: str) -> str:
    """A path as it is; a bare name is one of the public tokenizers, looked up where the task runs."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_of_character() -> dict[str, int]:
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteLevel:
    """A byte-level BPE of the tokenizers library. Where merges rank by id, tiktoken gives the same ids sooner."""

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        added = {t["content"] for t in stored.get("added_tokens", [])}
        shown, vocabulary = _byte_of_character(), stored["model"]["vocab"]
        self.bytes = [b""] * (1 + max([*vocabulary.values(), *[t["id"] for t in stored.get("added_tokens", [])]]))
        for token, at in vocabulary.items():
            self.bytes[at] = token.encode() if token in added else bytes(shown[c] for c in token)
        self.fast = self._fast(stored, vocabulary, added)

    def _fast(self, stored: dict, vocabulary: dict[str, int], added: set[str]):
        merges = [m if isinstance(m, list) else m.split(" ") for m in stored["model"]["merges"]]
        made = [vocabulary.get("".join(m), -1) for m in merges]
        before = stored.get("pre_tokenizer") or {}
        plain = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
        model = not (stored["model"].get("ignore_merges") or stored["model"].get("dropout"))
        if not plain or not model or stored.get("normalizer") or made != sorted(set(made)):
            return None
        import public_tokenizers
        import tiktoken

        ranks = {self.bytes[at]: at for token, at in vocabulary.items() if token not in added}
        return tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None and (len(text) < LONG_SPACE or not _LONG_SPACE.search(text)):
            return np.array(self.fast.encode_ordinary(text), dtype=np.int64)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.int64)


class Pieces:
    """A sentencepiece model that puts a space before the text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.bytes = [self._bytes(i) for i in range(self.model.get_piece_size())]

    def _bytes(self, at: int) -> bytes:
        piece = self.model.id_to_piece(at)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(at) else piece.replace("▁", " ").encode()

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text), dtype=np.int64)


@lru_cache(maxsize=4)
def _sides(byte_level: str, pieces: str) -> tuple[ByteLevel, Pieces]:
    """Loaded once a worker."""
    return ByteLevel(located(byte_level)), Pieces(located(pieces))


def _widening(ends_a: np.ndarray, ends_b: np.ndarray, lo: int, hi: int) -> int:
    """The inner token of lo..hi nearest the middle whose end both sides share, or -1."""
    middle, width = (lo + hi - 2) // 2, PROBES
    while True:
        first, last = max(lo, middle - width), min(hi - 1, middle + width + 1)
        inner = ends_a[first:last]
        shared = np.flatnonzero(ends_b[np.searchsorted(ends_b, inner)] == inner)
        if len(shared):
            return int(first + shared[np.argmin(np.abs(shared + first - middle))])
        if first == lo and last == hi - 1:
            return -1
        width *= 4


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """For each token of the first side, if a group ends with it.

    The ends rise over all intervals; an interval is the tokens lo to hi - 1, and its last end is shared.
    """
    cut = np.zeros(len(ends_a), dtype=bool)
    cut[hi - 1] = True
    probe = np.zeros(len(lo), dtype=np.int64)
    while len(lo):
        inner = hi - 1 - lo
        go = probe < inner  # an interval whose inner ends are all probed is a leaf
        lo, hi, probe, inner = lo[go], hi[go], probe[go], inner[go]
        half = (probe + 1) // 2
        at = lo + (inner - 1) // 2 + np.where(probe % 2 == 1, half, -half)
        found = ends_b[np.searchsorted(ends_b, ends_a[at])] == ends_a[at]
        for k in np.flatnonzero(~found & (probe >= PROBES)):
            at[k] = _widening(ends_a, ends_b, lo[k], hi[k])
            found[k] = at[k] >= 0
            probe[k] = inner[k]
        cut[at[found]] = True
        middle = at[found] + 1
        lo, hi, probe = (
            np.concatenate([lo[~found], lo[found], middle]),
            np.concatenate([hi[~found], middle, hi[found]]),
            np.concatenate([probe[~found] + 1, np.zeros(2 * len(middle), dtype=np.int64)]),
        )
    return cut


def _runs(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... inside each of consecutive runs of the given lengths."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


@lru_cache(maxsize=8)
def _written(size: int, mark: str) -> np.ndarray:
    return np.array([f"{i}{mark}" for i in range(size)], dtype=object)


class Aligned:
    """Groups and links of the texts of a slice; ``of`` are the texts' numbers, those without tokens left out."""

    def __init__(self, texts: list[bytes], byte_level: str, pieces: str):
        side_a, side_b = _sides(byte_level, pieces)
        self.of, ids_a, ids_b = [], [], []
        for i, data in enumerate(texts):
            if not data:
                continue
            text, whole = data.decode("utf-8", "replace"), b" " + data
            a = side_a.ids(" " + text)
            if b"".join(map(side_a.bytes.__getitem__, a.tolist())) != whole:
                continue
            b = side_b.ids(text)
            if b"".join(map(side_b.bytes.__getitem__, b.tolist())) != whole:
                continue
            self.of.append(i)
            ids_a.append(a)
            ids_b.append(b)
        self.n_a, self.n_b = np.array([len(a) for a in ids_a], dtype=np.int64), np.array([len(b) for b in ids_b], dtype=np.int64)
        if not self.of:
            return
        self.a, self.b = np.concatenate(ids_a), np.concatenate(ids_b)
        self.size_a, self.size_b = len(side_a.bytes), len(side_b.bytes)
        ends_a = np.cumsum(np.array([len(t) for t in side_a.bytes], dtype=np.int64)[self.a])
        ends_b = np.cumsum(np.array([len(t) for t in side_b.bytes], dtype=np.int64)[self.b])
        hi = np.cumsum(self.n_a)
        last = np.flatnonzero(shared_cuts(ends_a, ends_b, hi - self.n_a, hi))
        self.end_a, self.end_b = last + 1, np.searchsorted(ends_b, ends_a[last]) + 1
        self.start_a, self.start_b = np.r_[0, self.end_a[:-1]], np.r_[0, self.end_b[:-1]]
        self.last_group = np.searchsorted(self.end_a, hi) + 1
        self.first_group = np.r_[0, self.last_group[:-1]]

    def digests(self) -> list[str]:
        """sha256 of each text's groups, written out in order."""
        size_a, size_b = self.end_a - self.start_a, self.end_b - self.start_b
        out = np.empty(len(self.a) + len(self.b), dtype=object)
        at = np.arange(len(self.a)) + np.repeat(self.start_b, size_a)
        out[at] = _written(self.size_a, ",")[self.a]
        out[at[self.end_a - 1]] = _written(self.size_a, "|")[self.a[self.end_a - 1]]
        at = np.arange(len(self.b)) + np.repeat(self.end_a, size_b)
        out[at] = _written(self.size_b, ",")[self.b]
        out[at[self.end_b - 1]] = _written(self.size_b, ";")[self.b[self.end_b - 1]]
        to = np.cumsum(self.n_a + self.n_b)
        return [sha256("".join(out[s:e].tolist())[:-1].encode()).hexdigest() for s, e in zip(np.r_[0, to[:-1]], to, strict=True)]

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of each text: its distinct pairs (first id * 2 ** 32 + second id, rising), and how many links each has."""
        size_a, size_b = self.end_a - self.start_a, self.end_b - self.start_b
        for first, last in zip(self.first_group, self.last_group, strict=True):
            a, b, start_a, start_b = size_a[first:last], size_b[first:last], self.start_a[first:last], self.start_b[first:last]
            small = a * b <= LARGE_GROUP
            across = np.repeat(b[small], a[small])  # for each first token of a small group, its second tokens
            own = np.repeat(np.repeat(start_a[small], a[small]) + _runs(a[small]), across)
            other = np.repeat(np.repeat(start_b[small], a[small]), across) + _runs(across)
            pairs, times = np.unique((self.a[own] << 32) | self.b[other], return_counts=True)
            for k in np.flatnonzero(~small):
                x, nx = np.unique(self.a[start_a[k] : start_a[k] + a[k]], return_counts=True)
                y, ny = np.unique(self.b[start_b[k] : start_b[k] + b[k]], return_counts=True)
                both, back = np.unique(np.concatenate([pairs, ((x[:, None] << 32) | y[None, :]).ravel()]), return_inverse=True)
                summed = np.zeros(len(both), dtype=np.int64)
                np.add.at(summed, back, np.concatenate([times, np.outer(nx, ny).ravel()]))
                pairs, times = both, summed
            yield pairs, times


_OWN = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, block long, pairs binary, times binary"


def aligned(docs: DataFrame, byte_level: str = BYTE_LEVEL, pieces: str = PIECES) -> DataFrame:
    """Of each document its numbers, digest, block, and its distinct pairs with their links as packed longs."""
    rows = narrowed(docs, "doc_id")
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *[part.split()[0] for part in _OWN.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 32, 0
        for part in slices(batches, limit=1 << 20):
            texts = [t.as_py() or b"" for t in part.column("text")]
            size = sum(map(len, texts))
            if held and held + size > BLOCK_BYTES:
                block, held = block + 1, 0
            held += size
            found, n = Aligned(texts, byte_level, pieces), part.num_rows
            numbers = np.zeros((4, n), dtype=np.int64)
            digests, packed, times = [""] * n, [b""] * n, [b""] * n
            if found.of:
                numbers[0, found.of], numbers[1, found.of] = found.n_a, found.n_b
                numbers[2, found.of] = found.last_group - found.first_group
                for i, digest, (pair, many) in zip(found.of, found.digests(), found.links(), strict=True):
                    digests[i], packed[i], times[i], numbers[3, i] = digest, pair.tobytes(), many.astype(np.int64).tobytes(), many.sum()
            columns = [part.column("doc_id"), *map(pa.array, numbers), pa.array(digests), pa.array(np.full(n, block)), pa.array(packed, pa.binary()), pa.array(times, pa.binary())]
            yield pa.record_batch(columns, names=names)

    return rows.mapInArrow(run, f"doc_id {kind}, {_OWN}")


def block_pairs(rows: DataFrame) -> DataFrame:
    """(block, pair, docs): in how many documents of a block a pair is linked; a block may come in parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            for block in np.unique(blocks):
                mine = batch.column("pairs").filter(pa.array(blocks == block))
                pairs, docs = np.unique(np.frombuffer(b"".join(p.as_py() for p in mine), dtype=np.int64), return_counts=True)
                for at in range(0, len(pairs), 65_536):
                    some = slice(at, at + 65_536)
                    yield pa.record_batch([pa.array(np.full(len(pairs[some]), block)), pa.array(pairs[some]), pa.array(docs[some])], names=["block", "pair", "docs"])

    return rows.select("block", "pairs").mapInArrow(run, "block long, pair long, docs long")


def alignment(docs: DataFrame, byte_level: str = BYTE_LEVEL, pieces: str = PIECES) -> DataFrame:
    """Groups and links of every document, with how well its pairs are supported by the corpus."""
    rows = written(aligned(docs, byte_level, pieces), "aligned")
    kind = rows.schema["doc_id"].dataType.simpleString()
    asked = written(block_pairs(rows), "asked")
    counts = written(asked.groupBy("pair").agg(F.sum("docs").alias("count")), "pairs")
    best = counts.groupBy(F.expr("shiftright(pair, 32)").alias("id")).agg(F.max("count").alias("most"))
    told = asked.select("block", "pair").join(counts, "pair").join(F.broadcast(best), F.expr("shiftright(pair, 32) = id"))  # a row an id of the vocabulary
    told = told.select("block", "pair", "count", (F.col("count") == F.col("most")).alias("best"))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def score(own: pa.Table, known: pa.Table) -> pa.Table:
        pairs, first = np.unique(known.column("pair").to_numpy(), return_index=True)
        counts, best = known.column("count").to_numpy()[first], known.column("best").to_numpy()[first]
        n_best, count_sum = [], []
        for packed, times in zip(own.column("pairs"), own.column("times"), strict=True):
            at, many = np.searchsorted(pairs, np.frombuffer(packed.as_py(), dtype=np.int64)), np.frombuffer(times.as_py(), dtype=np.int64)
            n_best.append(int(many[best[at]].sum()))
            count_sum.append(int((many * counts[at]).sum()))
        found = {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
        return pa.table({c: found[c] if c in found else own.column(c) for c in names})

    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return rows.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(score, schema)


def op13_shared_cuts(spark, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents"))
