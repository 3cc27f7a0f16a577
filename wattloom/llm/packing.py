"""Best-fit-decreasing packing of token sequences.

A segment tree over remaining capacities finds the tightest open bin in logarithmic time. Pieces of
one length are interchangeable, so the tree is asked once for a run of equal pieces and the whole
packing follows from how many pieces each length has: at most ``capacity`` numbers, whatever the size
of the table. The pieces themselves are ranked within their length and look up their place, spread
over the cluster. The result is the packing that best fit, taken piece by piece over the whole
table in order of falling length, gives.

Defined cases: a null text packs as an empty one (one closing id); repeated rows are packed each;
an empty table gives no rows; equal lengths may change places between runs, never the lengths of bins.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from unicodedata import is_normalized, normalize

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.common import narrowed, slices, table
from wattloom.session import written

CAPACITY, CLOSING_ID = 2048, 0
VOCABULARY = "word_bpe_49k.json"
#: Words a task remembers the ids of; it starts afresh beyond.
REMEMBERED = 300_000
#: A run of letters or of what is not ASCII, then punctuation that the tokenizer parts from letters wherever it stands.
_STEM = re.compile(rb"([A-Za-z\x80-\xff]+)([!-&(-/:;=?@\[-`{}~]*)")

# The tokenizer's merges see bytes as characters: printable ones as themselves, the others from 256 on in order.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SHOWN = [chr(b) if b in _PRINTABLE else chr(256 + sum(x not in _PRINTABLE for x in range(b))) for b in range(256)]


def _all_letters(stem: bytes) -> bool:
    """If the tokenizer sees letters only, as it sees them after its normaliser: any other character keeps the punctuation after it."""
    if stem.isascii():
        return True
    text = stem.decode("utf-8", "replace")
    return text.isalpha() and normalize("NFC", text).lower().isalpha()


class WordIds(dict):
    """A word's ids as little-endian unsigned 32-bit numbers, remembered.

    The tokenizer drops white space and never joins across it, so a text's ids are its words' ids.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.stems = Tokenizer.from_file(path), {}
        self.model = self.tokenizer.model

    def encoded(self, word: bytes) -> bytes:
        return np.array(self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids, dtype="<u4").tobytes()

    def remembered(self, stem: bytes) -> bytes:
        ids = self.stems.get(stem)
        if ids is None:
            if len(self.stems) >= REMEMBERED:
                self.stems.clear()
            ids = self.stems[stem] = self.of_letters(stem) or self.encoded(stem)
        return ids

    def of_letters(self, stem: bytes) -> bytes | None:
        """A normalised word of lower-case letters goes to the merges at once; what precedes them would leave it alone."""
        text = stem.decode("utf-8", "replace")
        if not text.isalpha() or text.lower() != text or not is_normalized("NFC", text):
            return None
        shown = text if text.isascii() else "".join([_SHOWN[b] for b in stem])
        return np.array([token.id for token in self.model.tokenize(shown)], dtype="<u4").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        parts = _STEM.fullmatch(word)
        if parts and _all_letters(parts[1]):
            ids = self.remembered(parts[1].lower()) + (self.remembered(parts[2]) if parts[2] else b"")
        else:
            ids = self.encoded(word)
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = ids
        return ids


_TOKENIZERS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One memory a worker, kept from task to task."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordIds(path)
    return _TOKENIZERS[path]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each document, and its place among the task's pieces of that length."""
    rows = narrowed(docs, "doc_id")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length int, ids_crc32 long, task int, nth long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, task, seen = word_ids(path), TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        closing = np.array([CLOSING_ID], dtype="<u4").tobytes()
        for part in slices(batches):
            row, nth, start, length, crc, rank = [], [], [], [], [], []
            for i, text in enumerate(part.column("text")):
                data = b"".join(map(ids.__getitem__, (text.as_py() or b"").split())) + closing
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    piece = data[at : at + 4 * capacity]
                    size = len(piece) // 4
                    row.append(i)
                    nth.append(k)
                    start.append(at // 4)
                    length.append(size)
                    crc.append(zlib.crc32(piece))
                    rank.append(seen[size])
                    seen[size] += 1
            arrays = [part.column("doc_id").take(pa.array(row, pa.int64())), pa.array(nth, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int32()), pa.array(crc, pa.int64()), pa.array([task] * len(row), pa.int32()), pa.array(rank, pa.int64())]
            yield pa.record_batch(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])

    return rows.mapInArrow(cut, schema)


class CapacityTree:
    """Which remaining capacities some open bin has; the smallest that is at least a length, in logarithmic time."""

    def __init__(self, capacity: int):
        self.base = 1 << (capacity + 1).bit_length()
        self.has = [False] * (2 * self.base)

    def set(self, remaining: int, there: bool) -> None:
        node = self.base + remaining
        self.has[node] = there
        while node > 1:
            node //= 2
            self.has[node] = self.has[2 * node] or self.has[2 * node + 1]

    def tightest(self, length: int) -> int | None:
        node = self.base + length
        if self.has[node]:
            return length
        while node > 1 and not (node % 2 == 0 and self.has[node + 1]):
            node //= 2
        if node <= 1:
            return None
        node += 1
        while node < self.base:
            node = 2 * node if self.has[2 * node] else 2 * node + 1
        return node - self.base


@dataclass
class Plan:
    """Runs of equal pieces: from its first rank on, a run fills bins ``bin``, ``bin + 1`` ... with ``each`` pieces from ``offset`` on."""

    length: np.ndarray
    rank: np.ndarray
    bin: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    bins: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bin and offset of each piece, by its length and its rank among all pieces of that length."""
        run = np.zeros(len(length), dtype=np.int64)
        for size in np.unique(length):
            first, end = np.searchsorted(self.length, size), np.searchsorted(self.length, size, side="right")
            here = length == size
            run[here] = first + np.searchsorted(self.rank[first:end], rank[here], side="right") - 1
        nth = rank - self.rank[run]
        return self.bin[run] + nth // self.each[run], self.offset[run] + nth % self.each[run] * length


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Best-fit decreasing of ``counts[length]`` pieces of each length.

    A bin whose remaining capacity is the tightest stays the tightest until no further piece of the
    run fits, so equal bins are filled one after another: the run takes them together. A visit leaves
    a bin less than half of what it had free, so a bin is in at most log2(capacity) + 1 runs.
    """
    tree, open_bins, bins, runs = CapacityTree(capacity), {}, 0, []

    def put(remaining: int, first: int, count: int) -> None:
        if remaining and count:
            if remaining not in open_bins:
                open_bins[remaining] = []
                tree.set(remaining, True)
            open_bins[remaining].append((first, count))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            remaining = tree.tightest(length)
            if remaining is None:
                remaining = capacity
                each = capacity // length
                first, there = bins, -(-left // each)
                bins += there
            else:
                each = remaining // length
                first, there = open_bins[remaining].pop()
                if not open_bins[remaining]:
                    del open_bins[remaining]
                    tree.set(remaining, False)
            taken = min(left, there * each)
            full, rest = divmod(taken, each)
            runs.append((length, rank, first, each, capacity - remaining))
            put(remaining - each * length, first, full)
            if rest:
                put(remaining - rest * length, first + full, 1)
            put(remaining, first + full + bool(rest), there - full - bool(rest))
            rank, left = rank + taken, left - taken
    ordered = np.array(sorted(runs), dtype=np.int64).reshape(-1, 5)
    return Plan(*ordered.T, bins)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its sequence_id and its offset there."""
    cut = written(pieces(docs, path, capacity), "pieces")
    tallies = written(cut.groupBy("length", "task").count(), "tallies")
    counts = {r["length"]: r["n"] for r in tallies.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # at most ``capacity`` rows
    plan = best_fit(counts, capacity)
    before = F.sum("count").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    starts = tallies.select("length", "task", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = cut.join(starts, ["length", "task"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))
    kind = ranked.schema["doc_id"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            length = part.column("length").to_numpy().astype(np.int64)
            sequence, offset = plan.place(length, part.column("rank").to_numpy())
            columns = [part.column(c) for c in ("doc_id", "piece", "start")] + [pa.array(length), part.column("ids_crc32"), pa.array(sequence), pa.array(offset)]
            yield pa.record_batch(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def public_vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_vocabulary())
