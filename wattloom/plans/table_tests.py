"""Declarative table tests: each yields one row (test, failed).

Tests are declared as values and compiled table by table: all tests of a table that look at rows are
counts in one aggregate, and the first test of a table that looks at groups (equal keys, or values that
another table must have) carries these counts along its grouping. So a table is read once, and once more
only for each further grouping.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Test:
    """One declared test: ``failed`` is what it counts of rows; ``by`` the columns it groups by; ``known`` where their values must occur."""

    table: str
    name: str
    failed: str = ""
    by: tuple[str, ...] = ()
    known: tuple[str, str] | None = None


def not_null(table: str, *columns: str) -> list[Test]:
    """Rows without a value."""
    return [Test(table, f"not_null {table}.{c}", f"{c} is null") for c in columns]


def unique(table: str, *columns: str) -> list[Test]:
    """Values (or combinations of values) that occur more than once."""
    return [Test(table, f"unique {table}.{'+'.join(columns)}", by=columns)]


def relationship(table: str, column: str, other: str, other_column: str) -> list[Test]:
    """Rows whose value is missing from the other table; counted per value before the join."""
    return [Test(table, f"relationship {table}.{column}", by=(column,), known=(other, other_column))]


def accepted_range(table: str, column: str, low: float | None = None, high: float | None = None, inclusive: bool = True) -> list[Test]:
    """Rows outside the range; a missing value is not outside."""
    tests = []
    if low is not None:
        tests.append(f"{column} {'<' if inclusive else '<='} {low}")
    if high is not None:
        tests.append(f"{column} {'>' if inclusive else '>='} {high}")
    return [Test(table, f"accepted_range {table}.{column}", " or ".join(tests))]


def accepted_values(table: str, column: str, values: list[str]) -> list[Test]:
    listed = ", ".join(f"'{v}'" for v in values)
    return [Test(table, f"accepted_values {table}.{column}", f"{column} not in ({listed})")]


def _grouped(df: DataFrame, test: Test, rows: list[Test], tables: dict[str, DataFrame]) -> DataFrame:
    """One pass that groups by the test's columns and counts the row tests on the way."""
    groups = df.groupBy(*test.by).agg(F.count(F.lit(1)).alias("_n"), *[F.expr(f"count_if({r.failed})").alias(f"_r{i}") for i, r in enumerate(rows)])
    failed = "count_if(_n > 1)"
    if test.known:
        other, column = test.known
        groups = groups.join(tables[other].selectExpr(f"{column} as _known").distinct(), F.col(test.by[0]) == F.col("_known"), "left")
        failed = f"coalesce(sum(case when {test.by[0]} is not null and _known is null then _n end), 0)"
    return groups.agg(F.expr(failed).alias("_g"), *[F.expr(f"coalesce(sum(_r{i}), 0)").alias(f"_r{i}") for i in range(len(rows))])


def compiled(tests: Iterable[Test], tables: dict[str, DataFrame]) -> DataFrame:
    """(test, failed) of all tests, each table read once and once more for each grouping after its first."""
    by_table: dict[str, list[Test]] = {}
    for test in tests:
        by_table.setdefault(test.table, []).append(test)
    frames = []
    for table, own in by_table.items():
        df, rows, groups = tables[table], [t for t in own if not t.by], [t for t in own if t.by]
        for k, test in enumerate(groups or [None]):
            carried = [] if k else rows
            if test is None:
                counts = df.agg(*[F.expr(f"count_if({r.failed})").alias(f"_r{i}") for i, r in enumerate(carried)])
            else:
                counts = _grouped(df, test, carried, tables)
            named = [(r.name, f"_r{i}") for i, r in enumerate(carried)] + ([(test.name, "_g")] if test else [])
            pairs = ", ".join(f"'{name}', cast({c} as bigint)" for name, c in named)
            frames.append(counts.selectExpr(f"stack({len(named)}, {pairs}) as (test, failed)"))
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def _row(df: DataFrame, name: str, failed: str) -> DataFrame:
    return df.agg(F.expr(failed).cast("long").alias("failed")).selectExpr(f"'{name}' as test", "failed")


def fact_populated(fact: DataFrame, expected_keys: int) -> DataFrame:
    """The fact table is not empty and holds every configured key."""
    return fact.groupBy("ba_code").agg(F.count(F.lit(1)).alias("n")).agg(
        F.expr(f"case when coalesce(sum(n), 0) > 0 and count(*) = {expected_keys} then 0L else 1L end").alias("failed")
    ).selectExpr("'fact_table_populated' as test", "failed")


def benchmark_present(accuracy: DataFrame, more_than: int = 1000) -> DataFrame:
    return _row(accuracy, "benchmark_present", f"case when count(*) > {more_than} then 0 else 1 end")


#: Every declared test of the data model.
MODEL_TESTS = [
    *not_null("fact_demand_hourly", "period_utc", "ba_code"),
    *not_null("dim_ba", "ba_code"),
    *unique("dim_ba", "ba_code"),
    *not_null("dim_date", "date_day"),
    *unique("dim_date", "date_day"),
    *not_null("stg_demand_hourly", "period_utc", "ba_code", "demand_mwh"),
    *relationship("stg_demand_hourly", "ba_code", "dim_ba", "ba_code"),
    *accepted_range("stg_demand_hourly", "demand_mwh", low=0, inclusive=False),
    *accepted_values("stg_demand_hourly", "day_type", ["Weekday", "Weekend", "Holiday"]),
    *accepted_range("stg_forecast_accuracy", "abs_pct_error", 0, 500),
    *not_null("mart_daily_demand", "ba_code", "date_local"),
    *accepted_range("mart_daily_demand", "load_factor", 0, 1),
    *accepted_range("mart_daily_demand", "peak_hour_local", 0, 23),
    *unique("mart_daily_demand", "ba_code", "date_local"),
    *unique("mart_load_profile", "ba_code", "season", "day_type", "hour_local"),
    *not_null("mart_forecast_scorecard", "eia_mape_pct"),
    *accepted_range("mart_forecast_scorecard", "eia_mape_pct", 0, 100),
    *accepted_range("mart_peak_events", "pct_of_all_time_peak", 0, 100.01),
]


def model_tests(gold: dict[str, DataFrame], marts: dict[str, DataFrame]) -> DataFrame:
    return compiled(MODEL_TESTS, {**gold, **marts})
