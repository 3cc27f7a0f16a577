"""Nearest neighbours through stable projections and a kd-tree.

Unit vectors are projected to a few Gaussian directions. A kd-tree over the projections cuts the table
into cells; a query is answered in its own cell first, which bounds its k-th distance, and then in
every cell that the bound does not rule out. In a cell, candidates are verified on the original vectors
in order of projected distance until the next one is so far away that, by the chi-square law of
projected distances, a nearer original is improbable. Equal queries are searched once.

Copies of a vector beyond the k + 1 smallest ids can be in no answer (the smaller ids come first), so
they are ranked, not searched. Every other row is indexed. Large cells are dealt out in blocks, and so
are queries, so no group grows with the table.

Defined cases: vectors that are null, empty, zero, or hold a null or non-finite component, and rows without
an id, take no part; rows that share the query's id are the query's own; a repeated id counts once;
vectors are compared with vectors of their own length only; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.common import table
from wattloom.session import written

NEAREST, EVERY = 5, 50
DIRECTIONS, CERTAINTY, SEED = 8, 0.97, 11
#: Rows a cell should hold, rows of a block of a large cell, queries of a block.
CELL_ROWS, BLOCK_ROWS, BLOCK_QUERIES = 4096, 16_384, 8192
#: The tree's planes come from about so many projected rows; it has at most a cell for every 16 of them.
SAMPLE_ROWS = 32_768
FIRST_CHUNK = 128


def chi_square_quantile(share: float, freedom: int) -> float:
    """For an even number of degrees of freedom, by bisection on the closed form."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        x = (low + high) / 2
        term = total = 1.0
        for j in range(1, freedom // 2):
            term *= x / 2 / j
            total += term
        low, high = (x, high) if 1 - math.exp(-x / 2) * total < share else (low, x)
    return high


def kd_planes(points: np.ndarray, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """By level, the direction and median each node splits at; children of node i are 2i and 2i + 1."""
    groups, levels = [points], []
    for _ in range(depth):
        axes = np.array([int(g.var(axis=0).argmax()) if len(g) else 0 for g in groups])
        cuts = np.array([float(np.median(g[:, a])) if len(g) else 0.0 for g, a in zip(groups, axes, strict=True)])
        levels.append((axes, cuts))
        groups = [part for g, a, c in zip(groups, axes, cuts, strict=True) for part in (g[g[:, a] < c], g[g[:, a] >= c])]
    return levels


def cells_of(points: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    cell = np.zeros(len(points), dtype=np.int64)
    rows = np.arange(len(points))
    for axes, cuts in levels:
        cell = 2 * cell + (points[rows, axes[cell]] >= cuts[cell])
    return cell


def _vectors(blobs, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, blobs)), kind).reshape(len(blobs), -1).astype(np.float64) if len(blobs) else np.zeros((0, 0))


def _projected(vectors: np.ndarray) -> np.ndarray:
    directions = np.random.default_rng(SEED).normal(size=(vectors.shape[1], DIRECTIONS))
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)) @ directions


def answered(query: np.ndarray, at: np.ndarray, ids: np.ndarray, vectors: np.ndarray, norms: np.ndarray, points: np.ndarray, wanted: int, farthest: float, limit: float) -> list[tuple[float, int]]:
    """The best (score, id) of one query in one cell. ``farthest``: the squared distance that is already reached elsewhere."""
    apart = ((points - at) ** 2).sum(axis=1)
    order = np.argsort(apart, kind="stable")
    norm = np.sqrt((query * query).sum())
    best: list[tuple[float, int]] = []
    done, chunk = 0, FIRST_CHUNK
    while done < len(order) and apart[order[done]] < farthest * limit:
        take = order[done : done + chunk]
        score = (vectors[take] * query).sum(axis=1) / (norms[take] * norm)  # row by row: equal vectors get equal scores
        best = sorted([*best, *zip((-score).tolist(), ids[take].tolist(), strict=True)])[:wanted]
        if len(best) == wanted:
            farthest = min(farthest, max(0.0, 2 + 2 * best[-1][0]) * (1 + 1e-9) + 1e-12)
        done, chunk = done + chunk, 2 * chunk
    return best


def _search(wanted: int, kind: str, limit: float):
    schema = "query long, score double, vec_id long"

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(rows):
            vectors, ids = _vectors(rows["vector"], kind), rows["vec_id"].to_numpy()
            points, norms = _projected(vectors), np.sqrt((vectors * vectors).sum(axis=1))
            asked = _vectors(queries["vector"], kind)
            for q, vector, at, farthest in zip(queries["query"], asked, _projected(asked), queries["farthest"], strict=True):
                out += [(q, -s, i) for s, i in answered(vector, at, ids, vectors, norms, points, wanted, farthest, limit)]
        return pd.DataFrame(out, columns=["query", "score", "vec_id"]).astype({"query": "int64", "score": "float64", "vec_id": "int64"})

    return run, schema


def _best(found: DataFrame, wanted: int) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return found.groupBy("query", "vec_id").agg(F.max("score").alias("score")).withColumn("nth", nth).where(F.col("nth") <= wanted)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, vector (the components' bytes) and its length."""
    kind = "float" if "float" in vectors.schema["embedding"].dataType.simpleString() else "double"
    rows = vectors.select("vec_id", F.col("embedding").cast(f"array<{kind}>").alias("e"))
    sound = "vec_id is not null and e is not null and size(e) > 0 and forall(e, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(e, x -> x <> 0)"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = np.float32 if kind == "float" else np.float64
        for batch in batches:
            blobs = [np.array(e, dtype=dtype).tobytes() for e in batch.column("e").to_pylist()]
            yield pa.record_batch([batch.column("vec_id").cast(pa.int64()), pa.array(blobs, pa.binary())], names=["vec_id", "vector"])

    return rows.where(sound).mapInArrow(pack, "vec_id long, vector binary")


def _one_length(rows: DataFrame, kind: str, nearest: int, every: int) -> DataFrame:
    spark, wanted = rows.sparkSession, nearest + 1
    limit = chi_square_quantile(CERTAINTY, DIRECTIONS)
    copies = F.dense_rank().over(Window.partitionBy("vector").orderBy("vec_id"))
    indexed = written(rows.withColumn("copy", copies).where(F.col("copy") <= wanted).select("vec_id", "vector"), "indexed")
    asked = rows.where(F.col("vec_id") % every == 0).select("vec_id", "vector").distinct()
    reps = asked.groupBy("vector").agg(F.min("vec_id").alias("query"))
    members = asked.join(reps, "vector").select("vec_id", "query")
    n = indexed.count()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column("vector").to_pylist()
            yield pa.record_batch([pa.array(_projected(_vectors(blobs, kind)).tolist(), pa.list_(pa.float64()))], names=["point"])

    drawn = indexed.where(F.expr(f"pmod(xxhash64(vec_id, 'tree'), 1000000007L) < {min(1.0, SAMPLE_ROWS / max(n, 1))!r}D * 1000000007L"))
    sample = np.array([r["point"] for r in drawn.select("vector").mapInArrow(project, "point array<double>").collect()], dtype=np.float64).reshape(-1, DIRECTIONS)
    depth = max(0, math.ceil(math.log2(max(1, min(n / CELL_ROWS, len(sample) / 16)))))
    planes = kd_planes(sample, depth)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _projected(_vectors(batch.column("vector").to_pylist(), kind))
            yield pa.record_batch([*batch.columns, pa.array(cells_of(points, planes)), pa.array(points.tolist(), pa.list_(pa.float64()))], names=[*batch.schema.names, "cell", "point"])

    placed = written(indexed.mapInArrow(place, "vec_id long, vector binary, cell long, point array<double>"), "placed")
    bounds = placed.groupBy("cell").agg(F.count("*").alias("n"), *[f(F.col("point")[i]).alias(f"{f.__name__}{i}") for f in (F.min, F.max) for i in range(DIRECTIONS)]).collect()  # a row a cell
    cells = np.array([r["cell"] for r in bounds], dtype=np.int64)
    low, high = (np.array([[r[f"{f}{i}"] for i in range(DIRECTIONS)] for r in bounds]).reshape(-1, DIRECTIONS) for f in ("min", "max"))
    n_blocks = {r["cell"]: -(-r["n"] // BLOCK_ROWS) for r in bounds}
    query_blocks = max(1, -(-reps.count() // BLOCK_QUERIES))
    sizes = spark.createDataFrame(sorted(n_blocks.items()), "cell long, blocks long")
    dealt = placed.join(F.broadcast(sizes), "cell").select("cell", F.expr("pmod(xxhash64(vec_id), blocks)").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("of"), "vec_id", "vector")

    def visits(home: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                blobs = batch.column("vector").to_pylist()
                points = _projected(_vectors(blobs, kind)) if blobs else np.zeros((0, DIRECTIONS))
                far = batch.column("farthest").to_numpy()
                own = cells_of(points, planes)
                row, to = [], []
                for i, point in enumerate(points):
                    if home:
                        chosen = own[i : i + 1]
                    else:
                        gap = (np.maximum(0, np.maximum(low - point, point - high)) ** 2).sum(axis=1)
                        chosen = cells[(gap < far[i] * limit) & (cells != own[i])]
                    for c in chosen:
                        for b in range(n_blocks.get(int(c), 0)):
                            row.append(i)
                            to.append((int(c), b))
                yield pa.record_batch(
                    [pa.array([c for c, _ in to], pa.int64()), pa.array([b for _, b in to], pa.int64()), *[batch.column(k).take(pa.array(row, pa.int64())) for k in ("query", "vector", "farthest")]],
                    names=["cell", "block", "query", "vector", "farthest"],
                )

        return run

    run, schema = _search(wanted, kind, limit)
    of = F.expr(f"cast(pmod(xxhash64(query), {query_blocks}) as int)").alias("of")
    keys = ["cell", "block", "of"]

    def round_of(asked: DataFrame, home: bool) -> DataFrame:
        sent = asked.mapInArrow(visits(home), "cell long, block long, query long, vector binary, farthest double").withColumn("of", of)
        return sent.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInPandas(run, schema)

    first = reps.select("query", "vector", F.lit(float("inf")).alias("farthest"))
    near = written(round_of(first, True), "near")
    reached = _best(near, wanted).groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("worst"))
    farthest = F.when(F.col("n") == wanted, F.greatest(F.lit(0.0), 2 - 2 * F.col("worst")) * (1 + 1e-9) + 1e-12).otherwise(F.lit(float("inf")))
    rest = first.drop("farthest").join(reached, "query", "left").select("query", "vector", F.coalesce(farthest, F.lit(float("inf"))).alias("farthest"))
    best = _best(near.unionByName(round_of(rest, False)), wanted)
    told = members.withColumnRenamed("vec_id", "query_id").join(best.select("query", "vec_id", "score"), "query").where("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return told.withColumn("rank", rank).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(vectors: DataFrame, nearest: int = NEAREST, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest rows by cosine of every row whose id is divisible by ``every``."""
    kind = "f4" if "float" in vectors.schema["embedding"].dataType.simpleString() else "f8"
    rows = written(usable(vectors), "vectors")
    lengths = sorted(r[0] for r in rows.select(F.length("vector")).distinct().collect())
    parts = [_one_length(rows.where(F.length("vector") == size) if len(lengths) > 1 else rows, kind, nearest, every) for size in lengths]
    if not parts:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def op7_projected_kd_search(spark, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))
