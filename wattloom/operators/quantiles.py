"""Exact quantiles of groups of any size, by histogram and selection.

``percentile`` keeps every distinct value of a group in one task. Here values are first counted
(map-side), a monotone bin of the value gives a small histogram per group, the few bins that hold a
wanted rank are cut finer, and only the parts that hold it are sorted. The result is the linear-interpolation quantile, exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Monotone in the value and 0.3 % of it wide, however small or large it is.
_BIN = "cast(case when _x = 0 then 0 else signum(_x) * (floor(256D * log2(abs(_x))) + 280000D) end as int)"
#: Each picked bin is cut into so many equal parts, of which only those with a wanted rank are sorted.
PARTS = 4096


def _histogram(counts: DataFrame, keys: list[str], by: list[str], extra: list[str]) -> DataFrame:
    """Per key, the cells ``by`` in order with how many values lie before and up to each; ``extra`` SQL aggregates ride along."""
    listed, ordered = ", ".join(keys), ", ".join(by)
    cells = counts.groupBy(*keys, *by).agg(F.sum("_n").alias("_n"), *[F.expr(e) for e in extra])
    return cells.selectExpr(
        "*",
        f"sum(_n) over (partition by {listed} order by {ordered} rows between unbounded preceding and current row) as _end",
        f"sum(_n) over (partition by {listed}) as _sum",
    ).selectExpr("*", "_end - _n as _before")


def grouped_quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float | str]) -> DataFrame:
    """One row per group with a column per wanted quantile. NULLs, NaN and infinities are ignored; keys are not NULL.

    A quantile is a share from 0 to 1, or SQL text for a rank from 0 in terms of the group's
    ``_total``.
    """
    group = keys or ["_all"]
    ranks = {name: f"({p})" if isinstance(p, str) else f"({p}D * (_total - 1))" for name, p in probs.items()}
    edges = [f"{edge}({rank})" for rank in ranks.values() for edge in ("floor", "ceil")]
    holds = " or ".join(f"({e} >= _before and {e} < _end)" for e in edges)
    counts = (
        df.selectExpr(*keys, *([] if keys else ["0 as _all"]), f"cast({value} as double) as _x")
        .where("abs(_x) < double('infinity')")
        .selectExpr(*group, "_x", f"{_BIN} as _bin")
        .groupBy(*group, "_bin", "_x")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    bins = _histogram(counts, group, ["_bin"], ["min(_x) as _low", "max(_x) as _high"])
    bins = bins.withColumnRenamed("_sum", "_total").where(holds).select(*group, "_bin", "_low", "_high", "_total", F.col("_before").alias("_start"))
    part = f"case when _high > _low then cast(least(floor((_x - _low) / (_high - _low) * {PARTS}), {PARTS - 1}) as int) else 0 end"
    inside = counts.join(bins, [*group, "_bin"]).withColumn("_part", F.expr(part))
    parts = _histogram(inside, [*group, "_bin"], ["_part"], ["max(_start) as _start", "max(_total) as _total"])
    parts = parts.selectExpr(*group, "_bin", "_part", "_total", "_start + _before as _before", "_start + _end as _end").where(holds)
    placed = (
        inside.drop("_total").join(parts.drop("_end"), [*group, "_bin", "_part"])
        .selectExpr(
            *group, "_x", "_n", "_total",
            f"_before + sum(_n) over (partition by {', '.join(group)}, _bin, _part order by _x "
            "rows between unbounded preceding and current row) as _to",
        )
        .selectExpr(*group, "_x", "_total", "_to - _n as _from", "_to")
    )
    aggs = [F.max("_total").alias("_total")]
    for name, rank in ranks.items():
        for side, edge in (("lo", "floor"), ("hi", "ceil")):
            aggs.append(
                F.expr(f"max(case when _from <= {edge}({rank}) and {edge}({rank}) < _to then _x end)").alias(f"_{side}_{name}")
            )
    return (
        placed.groupBy(*group)
        .agg(*aggs)
        .selectExpr(
            *keys,
            *[f"_lo_{n} + (_hi_{n} - _lo_{n}) * ({rank} - floor({rank})) as {n}" for n, rank in ranks.items()],
        )
    )


def with_group_median(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Attach the exact median of the group to each row."""
    return df.join(grouped_quantiles(df, keys, value, {name: 0.5}), keys, "left")
