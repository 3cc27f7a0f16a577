"""Connected components of an edge table, by rounds of star contraction written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.session import written


def _contracted(edges: DataFrame, upward: bool) -> DataFrame:
    """One star step on (a, b) with a > b: neighbours move to the smallest neighbour of their centre.

    ``upward`` moves the larger neighbours of every node; otherwise the smaller ones and the node itself.
    """
    if upward:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = around.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        joined = edges.join(least, "a")
        moved = joined.select(F.col("b").alias("x"), F.col("m").alias("y")).unionByName(joined.select(F.col("a").alias("x"), F.col("m").alias("y")))
        moved = moved.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
    return moved.where("a <> b").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("sum(cast(xxhash64(a, b) as decimal(38, 0)))")).first())


def components(edges: DataFrame, most_rounds: int = 64) -> DataFrame:
    """(node, root) of every node that has an edge; the root is the smallest node of its component.

    ``edges`` has long columns a and b; loops, repeats and either direction are fine. Only a count and a
    checksum of each round reach the driver.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = written(now, "edges")
    mark = _mark(now)
    for _ in range(most_rounds):
        if not mark[0]:
            break
        now = written(_contracted(_contracted(now, True), False), "stars")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
