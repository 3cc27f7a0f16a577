"""SimHash near-duplicates, found through a Gray-order hierarchical index.

Distinct fingerprints are dealt out by parts of their bits (two fingerprints within the radius agree
on enough parts, so no link is lost). In a dealt group the fingerprints are sorted by Gray rank;
runs of neighbours share bits, which go to an upper node as a masked pattern, level by level. A search
adds up differences from the top and leaves a whole run as soon as they pass the radius, or once the
run is known to be in the searcher's component. A group yields one edge a fingerprint, never all pairs.

Defined cases: null and word-less texts have fingerprint 0 and link like any other; a null doc_id gets
a component but never names one unless nothing else is there; repeated rows share their component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from wattloom.llm.common import lowered, narrowed, slices, table, whole_rows
from wattloom.llm.graph import components
from wattloom.session import written

#: Words of a shingle, bits that linked fingerprints may differ in, seed of the shingle hash.
SHINGLE, RADIUS, SEED = 4, 4, 42
#: Wanted and largest size of a dealt group; a larger one is searched in pairs of blocks of this size.
GROUP, LARGEST = 1024, 32_768
#: Children of an index node; pairs of searcher and node held at once.
FAN, FRONTIER = 8, 4_000_000


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64 bits; a bit is 1 if over half the shingles' hashes have it."""
    words = lowered(text or b"").split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    if len(words) <= shingle:
        return xxh64_intdigest(line, SEED)
    starts = [0, *[e + 1 for e in ends[:-shingle]]]
    ends = ends[shingle - 1 :]
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), 65_536):  # bounds memory, not work
        hashes = np.fromiter((xxh64_intdigest(line[s:e], SEED) for s, e in zip(starts[at : at + 65_536], ends[at : at + 65_536], strict=True)), dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, *columns: str, shingle: int = SHINGLE) -> DataFrame:
    """The named columns and ``fp``, the fingerprint as a (signed) long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = np.array([fingerprint(t.as_py(), shingle) for t in part.column("text")], dtype=np.uint64).view(np.int64)
            yield pa.record_batch([*[part.column(c) for c in columns], pa.array(found)], names=[*columns, "fp"])

    rows = narrowed(docs, *columns)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(run, f"{kinds}, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each 64-bit code in the order of the Gray code."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _levels(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """From the leaves up: shared bits, their mask, and the mask less what the parent has factored out."""
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    bits, masks = [codes], [np.full(len(codes), full)]
    all_and, all_or = codes, codes
    while len(all_and) > FAN:
        starts = np.arange(0, len(all_and), FAN)
        all_and, all_or = np.bitwise_and.reduceat(all_and, starts), np.bitwise_or.reduceat(all_or, starts)
        mask = ~(all_and ^ all_or)
        bits.append(all_and & mask)
        masks.append(mask)
    levels = []
    for k, (own, mask) in enumerate(zip(bits, masks, strict=True)):
        rest = mask if k + 1 == len(bits) else mask & ~np.repeat(masks[k + 1], FAN)[: len(mask)]
        levels.append((own, mask, rest))
    return levels


def _merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        to = np.arange(len(label))
        np.minimum.at(to, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(jump := to[to], to):
            to = jump
        label = to[label]


def linked(codes: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For distinct codes sorted by Gray rank: the first code of each one's component within these codes."""
    levels, n = _levels(codes), len(codes)
    label = np.arange(n)
    at, step = 0, 16
    while at < n:
        who = np.arange(at, min(n, at + step))
        lows, highs = [label], [label]
        for _ in levels[1:]:
            starts = np.arange(0, len(lows[-1]), FAN)
            lows.append(np.minimum.reduceat(lows[-1], starts))
            highs.append(np.maximum.reduceat(highs[-1], starts))
        node = np.tile(np.arange(len(levels[-1][0])), len(who))
        searcher = np.repeat(who, len(levels[-1][0]))
        apart = np.zeros(len(node), dtype=np.uint8)
        for k in range(len(levels) - 1, -1, -1):
            bits, _, rest = levels[k]
            apart = apart + np.bitwise_count((codes[searcher] ^ bits[node]) & rest[node])
            own = label[searcher]
            go = (apart <= radius) & ((lows[k][node] != own) | (highs[k][node] != own)) & ((node + 1) * FAN**k > searcher)
            node, searcher, apart = node[go], searcher[go], apart[go]
            if k:
                node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                searcher, apart = np.repeat(searcher, FAN), np.repeat(apart, FAN)
                there = node < len(levels[k - 1][0])
                node, searcher, apart = node[there], searcher[there], apart[there]
        label = _merged(label, searcher, node)
        at += step
        step = max(16, min(4 * step, FRONTIER // n))
    return label


def _dealt(n: int, radius: int) -> tuple[int, int]:
    """Parts the bits are cut into, and bits of the key that a group shares, for n fingerprints."""
    wanted = max(0, math.ceil(math.log2(max(1, n / GROUP))))
    for parts in range(radius + 1, radius + 5):
        have = (parts - radius) * (64 // parts)
        if have >= wanted:
            break
    return parts, min(wanted, have)


def _keys(parts: int, bits: int, radius: int) -> Column:
    """One key for each choice of parts that may agree; of its bits the lowest ``bits`` count."""
    width, keys = 64 // parts, []
    for nth, chosen in enumerate(combinations(range(parts), parts - radius)):
        value = " | ".join(f"shiftleft(shiftrightunsigned(fp, {p * width}) & {(1 << width) - 1}L, {i * width})" for i, p in enumerate(chosen))
        keys.append(F.struct(F.lit(nth).alias("choice"), F.expr(f"({value}) & {(1 << bits) - 1}L").alias("key")))
    return F.explode(F.array(*keys))


def edges(distinct: DataFrame, n: int, radius: int = RADIUS) -> DataFrame:
    """(a, b): enough links between the distinct fingerprints ``fp`` to join every component."""
    parts, bits = _dealt(n, radius)
    dealt = distinct.select("fp", _keys(parts, bits, radius).alias("k")).select("fp", "k.choice", "k.key")
    large = dealt.groupBy("choice", "key").count().where(F.col("count") > LARGEST)
    dealt = dealt.join(large, ["choice", "key"], "left").withColumn("blocks", F.expr(f"cast(coalesce(ceil(2 * count / {LARGEST}), 1) as int)"))
    dealt = dealt.withColumn("own", F.expr("cast(pmod(xxhash64(fp), blocks) as int)")).withColumn("other", F.expr("explode(sequence(0, blocks - 1))"))
    dealt = dealt.select("choice", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp")

    def join(group: pd.DataFrame) -> pd.DataFrame:
        codes = group["fp"].to_numpy().view(np.uint64)
        codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        root = linked(codes, radius)
        moved = root != np.arange(len(codes))
        return pd.DataFrame({"a": codes[moved].view(np.int64), "b": codes[root[moved]].view(np.int64)})

    return dealt.groupBy("choice", "key", "low", "high").applyInPandas(join, "a long, b long")


def _placed(prints: DataFrame, radius: int) -> DataFrame:
    """(fp, least, root): each distinct fingerprint, its smallest doc_id, and the fingerprint that names its component."""
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(edges(classes.select("fp"), classes.count(), radius))
    placed = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return written(placed, "placed")


def grouped(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, component_id): for each distinct fingerprint, the smallest doc_id its component reaches.

    ``prints`` has doc_id and fp.
    """
    placed = _placed(prints, radius)
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return placed.join(named, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs``."""
    prints = written(fingerprints(docs, "doc_id", shingle=shingle), "prints")
    named = prints.join(grouped(prints, radius), "fp")
    return named.select("doc_id", F.expr("lower(lpad(hex(fp), 16, '0'))").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id, then the smallest hash of the row.

    A component whose rows all lack a doc_id keeps one of them, too.
    """
    rows = whole_rows(docs)
    named = rows.select(F.col("id").alias("doc_id"), "row", F.col("whole.text").alias("text"))
    prints = written(fingerprints(named, "doc_id", "row", shingle=shingle), "prints")
    placed = _placed(prints, radius)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("first")
    ahead = prints.groupBy("fp").agg(first).join(placed, "fp").groupBy("root").agg(F.min("first").alias("first"))
    kept = ahead.select(F.col("first.doc_id").alias("kept_id"), F.col("first.row").alias("kept_row"))
    chosen = rows.join(kept, rows["id"].eqNullSafe(kept["kept_id"]) & (rows["row"] == kept["kept_row"]), "left_semi")
    nth = F.row_number().over(Window.partitionBy("id", "row").orderBy("row"))  # rows that are equal throughout
    return chosen.withColumn("nth", nth).where("nth = 1").select("whole.*")


def op9_gray_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
