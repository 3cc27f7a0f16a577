"""Mixing sources to target weights by balanced sampling with the cube method.

Every document of a source is wanted equally often: target / size times. The whole part of that are
sure copies, the fraction is a probability of one more. The probabilities of a block of documents are
moved through the null space of the constraints (sum of words, number of documents) until at most two
of them are left between 0 and 1; what is left of all blocks goes through blocks again, until at most
two documents a source remain. Those land by the design of least variance that keeps their probabilities.
All draws come from seeds, so reruns agree.

Defined cases: a null text has no words; documents without words count as documents only; a null
source is the last source; rows that are equal throughout may trade places; a source of no words has
target 0; an empty table gives no rows.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.common import slices, table, whole_rows
from wattloom.session import written

#: Weights of the sources in order of their code points, repeating; no document is taken more often than REPEATS on average.
WEIGHTS, REPEATS = (1, 2, 3), 3
#: Documents whose probabilities are moved together.
BLOCK_UNITS, SEED = 2048, 20
#: So many equal rows are dealt to a block as one.
EQUAL_ROWS = 64


def targets(sizes: list[int], weights: list[float], repeats: float = REPEATS) -> list[float]:
    """Shares of all sizes by weight; none above ``repeats`` times its own size, what is over shared anew by weight."""
    out, free, rest = [0.0] * len(sizes), list(range(len(sizes))), float(sum(sizes))
    while free:
        whole = sum(weights[i] for i in free)
        over = [i for i in free if rest * weights[i] / whole > repeats * sizes[i]]
        if not over:
            for i in free:
                out[i] = rest * weights[i] / whole
            break
        for i in over:
            out[i] = float(repeats * sizes[i])
        rest -= sum(repeats * sizes[i] for i in over)
        free = [i for i in free if i not in set(over)]
    return out


def flight(sizes: list[float], chances: list[float], draw: random.Random) -> list[float]:
    """Moves chances until at most two lie strictly between 0 and 1; keeps sum(chance) and sum(chance * size).

    Each move is the null-space direction nearest to the largest undecided document alone: it settles,
    the others make up for it a little each, and what is left at the end is small.
    """
    out, size = np.array(chances, dtype=np.float64), np.array(sizes, dtype=np.float64)
    open_ = np.flatnonzero((out > 0) & (out < 1))
    open_ = open_[np.argsort(-size[open_], kind="stable")]
    x, p = size[open_], out[open_]
    while len(x) > 2:
        mean = x.mean()
        off = x - mean
        square = off @ off
        way = -(1 / len(x) + (off[0] / square) * off if square > 1e-9 * max(1.0, mean * mean) else np.full(len(x), 1 / len(x)))
        way[0] += 1
        if np.abs(way).max() < 1e-9:  # the largest alone can't move; any three sizes can
            way = np.zeros(len(x))
            way[:3] = x[1] - x[2], x[2] - x[0], x[0] - x[1]
        with np.errstate(divide="ignore", invalid="ignore"):
            ahead = np.where(way > 0, (1 - p) / way, np.where(way < 0, -p / way, np.inf)).min()
            back = np.where(way > 0, p / way, np.where(way < 0, (p - 1) / way, np.inf)).min()
        step = ahead if draw.random() * (ahead + back) < back else -back
        p = p + step * way
        settled = (p < 1e-9) | (p > 1 - 1e-9)
        out[open_[settled]] = np.round(p[settled])
        open_, x, p = open_[~settled], x[~settled], p[~settled]
    out[open_] = p
    return out.tolist()


def landing(chances: list[float], draw: random.Random) -> list[float]:
    """Settles the last one or two: both as rarely as their chances allow, which makes every total vary least."""
    out = list(chances)
    left = [u for u, p in enumerate(chances) if 0 < p < 1]
    x = draw.random()
    if len(left) == 1:
        out[left[0]] = 1.0 if x < chances[left[0]] else 0.0
    elif left:
        p, q = chances[left[0]], chances[left[1]]
        both = max(0.0, p + q - 1)
        first, second = x < p, x < both or p <= x < p + q - both
        out[left[0]], out[left[1]] = float(first), float(second)
    return out


def _moved(units: DataFrame) -> DataFrame:
    """One round: ``units`` (key, _row, nth, equal, source, size, chance, blocks) in blocks of their source; a source of one block lands, too.

    A unit stands for ``equal`` equal rows, numbered from ``nth`` on, until its block takes them one by one.
    """
    names = [c for c in units.columns if c != "blocks"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in units.schema if f.name in names)

    def move(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["mixed", "_row", "nth"], kind="stable")
        group = group.loc[group.index.repeat(group["equal"])]
        group = group.assign(nth=group["nth"] + group.groupby(level=0).cumcount(), equal=1)
        draw = random.Random(zlib.crc32(f"{SEED} {group['source'].iloc[0]} {group['block'].iloc[0]} {group['blocks'].iloc[0]}".encode()))
        chances = flight(group["size"].astype(float).tolist(), group["chance"].tolist(), draw)
        if group["blocks"].iloc[0] == 1:
            chances = landing(chances, draw)
        return group.assign(chance=chances)[names]

    dealt = units.withColumn("mixed", F.xxhash64("_row", "size", "nth", F.lit(SEED))).withColumn("block", F.expr("pmod(mixed, blocks)"))
    return dealt.groupBy("source", "block").applyInPandas(move, schema)


def _numbered(measured: DataFrame) -> DataFrame:
    """``measured`` with equal rows taken together, EQUAL_ROWS to a unit, so that their number parts them among the blocks."""
    same = measured.groupBy(*measured.columns).agg(F.count("*").alias("_rows"))
    parted = same.withColumn("nth", F.expr(f"explode(sequence(0L, _rows - 1, {EQUAL_ROWS}L))"))
    return parted.withColumn("equal", F.expr(f"least({EQUAL_ROWS}L, _rows - nth)")).drop("_rows")


def _blocks(counts: dict) -> dict:
    return {k: max(1, -(-n // BLOCK_UNITS)) for k, n in counts.items()}


def _with(units: DataFrame, values: dict, name: str, kind: str) -> DataFrame:
    """A column from a value of each source: as many rows as sources, joined by null-safe equality."""
    spark = units.sparkSession
    source = units.schema["source"].dataType.simpleString()
    side = spark.createDataFrame([(k, v) for k, v in values.items()], f"_of {source}, `{name}` {kind}")
    return units.join(F.broadcast(side), units["source"].eqNullSafe(side["_of"])).drop("_of")


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, _row (a hash of the whole row) and size in words of every row."""
    rows = whole_rows(docs).select(F.col("id").alias("doc_id"), F.col("whole.source").alias("source"), F.col("row").alias("_row"), F.col("whole.text").cast("binary").alias("text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            n = np.array([len((t.as_py() or b"").split()) for t in part.column("text")], dtype=np.int64)
            yield pa.record_batch([*[part.column(c) for c in ("doc_id", "source", "_row")], pa.array(n)], names=["doc_id", "source", "_row", "size"])

    return rows.mapInArrow(count, f"{kinds}, size long")


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """doc_id, source, _row, size, source_size, target and copies of every row of ``docs`` (doc_id, text, source).

    A row a source reaches the driver: its size and its number of documents.
    """
    measured = written(sizes(docs), "sizes")
    totals = {r["source"]: r for r in measured.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("docs")).collect()}
    order = sorted(totals, key=lambda s: (s is None, s if s is not None else ""))
    words = [totals[s]["size"] for s in order]
    wanted = dict(zip(order, targets(words, [weights[i % len(weights)] for i in range(len(order))], repeats), strict=True))
    often = {s: wanted[s] / totals[s]["size"] if totals[s]["size"] else 0.0 for s in order}
    sure = {s: min(int(k), repeats) for s, k in often.items()}
    counts = {s: totals[s]["docs"] for s in order}
    units = _with(_numbered(measured), {s: often[s] - sure[s] for s in order}, "chance", "double")
    decided, blocks = [], _blocks(counts)
    while True:
        moved = written(_moved(_with(units, blocks, "blocks", "long")), "moved")
        done = all(n == 1 for n in blocks.values())
        decided.append(moved if done else moved.where("chance in (0, 1)"))
        if done:
            break
        units = moved.where("chance not in (0, 1)")
        blocks = _blocks({s: 2 * n for s, n in blocks.items()})
    out = decided[0]
    for part in decided[1:]:
        out = out.unionByName(part)
    out = _with(_with(_with(out, sure, "sure", "long"), wanted, "target", "double"), {s: totals[s]["size"] for s in order}, "source_size", "long")
    return out.select("doc_id", "source", "_row", "size", "source_size", "target", F.expr("sure + cast(round(chance) as long)").alias("copies"))


def repeated(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``docs`` with every row as often as the mix takes it."""
    taken = mixed(docs, weights, repeats).groupBy("doc_id", "_row").agg(F.sum("copies").alias("copies")).where("copies > 0")
    rows = whole_rows(docs)
    joined = rows.join(taken, rows["id"].eqNullSafe(taken["doc_id"]) & (rows["row"] == taken["_row"])).select("whole", "id", "row", "copies")
    first = F.row_number().over(Window.partitionBy("id", "row").orderBy("row"))  # equal rows share their copies
    once = joined.withColumn("nth", first).where("nth = 1")
    return once.select("whole", F.expr("explode(array_repeat(1, cast(copies as int)))")).select("whole.*")


def op1_source_mix(spark, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).selectExpr("doc_id", "size", "source_size", "target", "copies * size as taken")
