import pandas as pd
import pytest
from pandas.tseries.holiday import USFederalHolidayCalendar
from pyspark.sql import functions as F

from wattloom.functions.holidays import is_holiday
from wattloom.functions.scalars import local_clock
from wattloom.operators.series import pivot_measures, series_bounds
from wattloom.plans.baselines import spine_breaks
from wattloom.plans.marts import build_marts
from wattloom.plans.table_tests import model_tests
from wattloom.plans.warehouse import build_dim_date, build_gold, build_silver
from wattloom.registry import AUTHORITIES, authorities
from wattloom.schemas import DIM_BA, assert_columns


def test_registry_orders_filters_and_rejects(spark):
    assert [r["ba_code"] for r in authorities(spark, " pjm, CISO ,,erco").collect()] == ["PJM", "CISO", "ERCO"]
    assert authorities(spark).count() == 12
    with pytest.raises(ValueError, match="XYZ"):
        authorities(spark, "PJM,XYZ")
    assert all(24 < a[5] < 50 and -125 < a[6] < -66 and a[2].startswith("America/") for a in AUTHORITIES)
    assert_columns(authorities(spark), DIM_BA, "dim_ba")


def test_holidays_equal_the_federal_calendar(spark):
    days = spark.sql("select explode(sequence(date'2015-01-01', date'2031-12-31')) as d")
    got = {r["d"] for r in days.where(is_holiday("d")).collect()}
    # The calendar library lists the holiday observed on 31 December under the year it falls in.
    want = {t.date() for t in USFederalHolidayCalendar().holidays("2015-01-01", "2031-12-31")}
    assert got == want
    assert pd.Timestamp("2021-12-31").date() in got


def test_calendar_edges_have_no_neighbour(spark):
    span = spark.sql("select date'2024-12-26' as date_local")
    calendar = build_dim_date(span, extra_days=5).orderBy("date_day").collect()
    assert len(calendar) == 6
    assert calendar[0]["is_day_after_holiday"] is False  # Christmas lies before the calendar
    assert calendar[-1]["is_day_before_holiday"] is False  # New Year lies after it


@pytest.mark.parametrize(
    ("zone", "instant", "local"),
    [
        ("America/New_York", "2024-03-10 06:30:00", "2024-03-10 01:30:00"),
        ("America/New_York", "2024-03-10 07:30:00", "2024-03-10 03:30:00"),
        ("America/Chicago", "2024-11-03 06:00:00", "2024-11-03 01:00:00"),
        ("America/Chicago", "2024-11-03 07:00:00", "2024-11-03 01:00:00"),
        ("America/Los_Angeles", "2024-07-01 00:00:00", "2024-06-30 17:00:00"),
    ],
)
def test_local_clock_follows_daylight_saving(spark, zone, instant, local):
    got = spark.sql(f"select {local_clock(repr(zone), f'timestamp{instant!r}')} as x").first()["x"]
    assert str(got) == local


def test_grain_spine_and_joins(gold):
    fact, silver = gold["fact_demand_hourly"], gold["silver_grid_hourly"]
    assert fact.count() > 10_000
    assert fact.groupBy("ba_code", "period_utc").count().where("count > 1").count() == 0
    assert spine_breaks(silver).count() == 0
    assert fact.where("temperature_2m is not null").count() / fact.count() > 0.95
    assert silver.where("period_local = cast(period_utc as timestamp_ntz)").count() == 0
    assert fact.join(gold["dim_date"], fact.date_local == gold["dim_date"].date_day, "left_anti").count() == 0
    assert fact.where("is_weekend <> (day_of_week >= 5)").count() == 0


def test_benchmark_error_is_plausible(gold):
    row = gold["fact_forecast_accuracy"].agg(F.count("*").alias("n"), F.avg("abs_pct_error").alias("mape")).first()
    assert row["n"] > 1000 and 0.5 < row["mape"] < 6


def test_flags_find_planted_faults(spark):
    values = [100.0 + i % 3 for i in range(60)]
    values[10] = 0.0                       # nonpositive, implausible, spike, ramp after it unknown
    values[20] = values[21] = values[22] = 100.5  # frozen at 22
    values[30] = 900.0                     # implausible
    values[59] = 160.0                     # spike on the very last row
    rows = [("PJM", i, "D", v) for i, v in enumerate(values) if i != 40]  # hour 40 is absent
    bronze = spark.createDataFrame(rows, "ba_code string, i int, measure_code string, value_mwh double").selectExpr(
        "timestamp'2024-01-10' + make_interval(0,0,0,0,i,0,0) as period_utc", "ba_code", "measure_code", "value_mwh"
    )
    gold = build_gold(pivot_measures(bronze), authorities(spark, "PJM"))
    fact = [r.asDict() for r in gold["fact_demand_hourly"].orderBy("period_utc").collect()]
    silver = [r.asDict() for r in gold["silver_grid_hourly"].orderBy("period_utc").collect()]
    assert len(fact) == 60
    assert silver[40]["flag_absent_interval"] and silver[40]["flag_missing_demand"] and not silver[39]["flag_absent_interval"]
    assert silver[22]["flag_frozen_reading"] and not silver[21]["flag_frozen_reading"]
    assert silver[0]["flag_frozen_reading"] is None  # equals nothing: not known
    assert fact[10]["flag_nonpositive_demand"] and fact[10]["demand_clean_mwh"] is None and fact[10]["flag_extreme_ramp"]
    assert fact[11]["flag_extreme_ramp"] is None  # ramp from zero has no percentage
    assert fact[30]["flag_implausible_magnitude"] and fact[30]["demand_clean_mwh"] is None and fact[30]["demand_mwh"] == 900.0
    assert fact[59]["flag_isolated_spike"] and fact[59]["demand_clean_mwh"] is None
    assert fact[12]["demand_clean_mwh"] == values[12]
    assert all(r["temperature_2m"] is None for r in fact)


def test_keys_outside_the_dimension_are_left_out(spark, bronze):
    gold = build_gold(pivot_measures(bronze), authorities(spark, "PJM"), None, series_bounds(bronze))
    assert [r["ba_code"] for r in gold["silver_grid_hourly"].select("ba_code").distinct().collect()] == ["PJM"]


def test_declared_tests_pass_on_clean_data(gold):
    marts = build_marts(gold["fact_demand_hourly"], gold["fact_forecast_accuracy"])
    failed = {r["test"]: r["failed"] for r in model_tests(gold, marts).collect()}
    assert len(failed) == 22
    # A day that DST or the calendar splits in two types never occurs; every test holds.
    assert {k: v for k, v in failed.items() if v} == {}


def test_first_of_equal_peaks_wins(spark):
    from wattloom.plans.marts import daily_demand

    rows = spark.createDataFrame([(h, 10.0 if h in (3, 7) else 5.0) for h in range(24)], "hour_local int, demand_mwh double").selectExpr(
        "*", "'A' as ba_code", "date'2024-01-01' as date_local", "'Weekday' as day_type", "'Winter' as season",
        "timestamp'2024-01-01' + make_interval(0,0,0,0,hour_local,0,0) as period_utc", "cast(null as double) as temperature_2m",
        "0D as heating_degrees", "0D as cooling_degrees",
    )
    assert daily_demand(rows).first()["peak_hour_local"] == 3


def test_a_stored_silver_table_gives_the_same_fact(gold):
    from wattloom.plans.warehouse import build_fact, demand_bounds

    again = build_fact(gold["silver_grid_hourly"], gold["dim_date"], demand_bounds(gold["silver_grid_hourly"]))
    fact = gold["fact_demand_hourly"]
    assert again.select(*fact.columns).exceptAll(fact).count() == 0 and again.count() == fact.count()


def test_compiled_tests_read_a_table_once(spark, tmp_path):
    """Counts of every kind of test against known faults, and one scan a table."""
    from wattloom.plans import table_tests as tt

    spark.sql("select * from values (1, 'a', 5.0D), (1, 'a', -1.0D), (2, null, null), (3, 'z', 7.0D), (null, 'b', 2.0D), (null, 'b', 2.0D) as t(k, c, v)").write.parquet(str(tmp_path / "t"))
    spark.sql("select * from values ('a'), ('b') as o(c)").write.parquet(str(tmp_path / "o"))
    tables = {"t": spark.read.parquet(str(tmp_path / "t")), "o": spark.read.parquet(str(tmp_path / "o"))}
    row_tests = [*tt.not_null("t", "k", "v"), *tt.accepted_range("t", "v", 0, 6), *tt.accepted_range("t", "v", low=2, inclusive=False), *tt.accepted_values("t", "c", ["a", "b"])]
    expected = {"not_null t.k": 2, "not_null t.v": 1, "accepted_values t.c": 1}
    for grouping, failed in ((tt.unique("t", "k"), 2), (tt.unique("t", "k", "c", "v"), 1), (tt.relationship("t", "c", "o", "c"), 1), ([], None)):
        found = tt.compiled([*row_tests, *grouping], tables)
        rows = [(r["test"], r["failed"]) for r in found.collect()]
        counts = dict(rows)
        assert len(rows) == len(row_tests) + len(grouping)
        assert expected.items() <= counts.items() and sorted(f for n, f in rows if n == "accepted_range t.v") == [2, 3]
        if grouping:
            assert counts[grouping[0].name] == failed
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 1 + sum(t.known is not None for t in grouping)
    empty = {name: df.limit(0) for name, df in tables.items()}
    assert {r["failed"] for r in tt.compiled([*row_tests, *tt.unique("t", "k"), *tt.relationship("t", "c", "o", "c")], empty).collect()} == {0}


def test_clock_changes_of_zones_with_and_without_daylight_saving(spark):
    from wattloom.plans.diagnostics import clock_changes

    rows = spark.range(24 * 366).selectExpr("timestamp'2024-01-01' + make_interval(0,0,0,0,cast(id as int),0,0) as period_utc", "cast(id as double) as demand_mwh")
    keys = spark.createDataFrame([("E", "America/New_York"), ("P", "America/Los_Angeles"), ("A", "America/Phoenix")], "ba_code string, timezone string")
    wide = rows.join(keys.select("ba_code").hint("broadcast")).selectExpr(
        "*", "demand_mwh as demand_forecast_mwh", "demand_mwh as net_generation_mwh", "demand_mwh as total_interchange_mwh"
    )
    found = clock_changes(build_silver(wide, keys)).orderBy("ba_code", "date_local").collect()
    days = [(r["ba_code"], str(r["date_local"]), r["hours_in_day"], r["hours_repeated"], r["offset_before"], r["offset_after"]) for r in found]
    assert days == [
        ("E", "2024-03-10", 23, 0, -5, -4), ("E", "2024-11-03", 25, 1, -4, -5),
        ("P", "2024-03-10", 23, 0, -8, -7), ("P", "2024-11-03", 25, 1, -7, -8),
    ]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_tables_are_written_when_asked_for(spark, monkeypatch):
    from wattloom.catalogue import base

    names = []
    monkeypatch.setattr(base, "written", lambda df, name: names.append(name) or df)
    fact = spark.range(3).selectExpr(
        "timestamp_seconds(id * 3600) as period_utc", "'A' as ba_code", "date'1970-01-01' as date_local", "cast(id as int) as hour_local",
        "double(10 + id) as demand_clean_mwh", "double(11) as demand_forecast_mwh",
    )
    build = {"dim_date": spark.range(1), "silver_grid_hourly": spark.range(2), "fact_demand_hourly": fact, "fact_forecast_accuracy": None}
    stored = base.Stored(build)
    assert stored["silver_grid_hourly"].count() == 2 and stored["dim_date"].count() == 1 and names == ["dim_date"]
    assert [stored["fact_forecast_accuracy"].count() for _ in range(2)] == [3, 3] and names == ["dim_date", "fact_demand_hourly", "fact_forecast_accuracy"]


def test_clock_changes_count_repeated_hours_without_expanding_rows(spark):
    from wattloom.plans.diagnostics import clock_changes

    hours = spark.range(24 * 400).selectExpr("timestamp'2023-01-01' + make_interval(0,0,0,0,cast(id as int),0,0) as period_utc", "'America/New_York' as timezone")
    silver = hours.selectExpr("'A' as ba_code", "period_utc", f"{local_clock()} as period_local").selectExpr(
        "*", "to_date(period_local) as date_local", "hour(period_local) as hour_local"
    )
    found = clock_changes(silver)
    assert [tuple(r)[1:] for r in found.selectExpr("ba_code", "string(date_local)", "hours_in_day", "hours_repeated", "offset_before", "offset_after").orderBy("date_local").collect()] == [
        ("2023-03-12", 23, 0, -5, -4), ("2023-11-05", 25, 1, -4, -5),
    ]
    assert "Expand" not in _plan(found)


def test_load_profile_ranks_by_hash_of_the_group(spark):
    from wattloom.plans.marts import load_profile

    rows = spark.range(4000).selectExpr(
        "concat('K', id % 3) as ba_code", "if(id % 5 = 0, null, 'Winter') as season", "'Weekday' as day_type", "cast(id % 7 as int) as hour_local",
        "double(pmod(xxhash64(id), 900L) + 100) as demand_mwh",
    ).unionByName(spark.sql("select 'K9' as ba_code, 'Winter' as season, 'Weekday' as day_type, 3 as hour_local, 5D as demand_mwh"))
    found = load_profile(rows)
    keys = ["ba_code", "season", "day_type", "hour_local"]
    got = {tuple(r[k] for k in keys): (r["p10_demand_mw"], r["p90_demand_mw"], r["observations"]) for r in found.collect()}
    want = rows.groupBy(*keys).agg(F.expr("percentile(demand_mwh, array(0.1, 0.9)) as p"), F.count("*").alias("n")).collect()
    assert got == {tuple(r[k] for k in keys): (*(float(int(v + 0.5)) for v in r["p"]), r["n"]) for r in want}
    assert "ObjectHashAggregate" not in _plan(found)


def test_merges_meet_the_records_of_an_hour_where_they_are_dealt(spark, tmp_path):
    from wattloom.catalogue import base
    from wattloom.operators.series import pivot_latest
    from wattloom.sources import adapters

    lines = spark.range(3000).selectExpr(
        "if(id % 50 = 0, null, id div 4) as l_orderkey", "id % 90 as l_partkey", "id % 200 as l_suppkey", "cast(id % 7 + 1 as int) as l_linenumber",
        "double(id % 50 + 1) as l_quantity", "double(id % 11) / 100 as l_discount", "double(id % 9) / 100 as l_tax", "if(id % 3 = 0, 'N', 'A') as l_returnflag",
        "if(id % 2 = 0, 'F', 'O') as l_linestatus", "date_add(date'1995-01-01', cast(id % 60 as int)) as l_shipdate",
    )
    lines.unionByName(lines.limit(20)).write.parquet(str(tmp_path / "lineitem.parquet"))
    for civil in (False, True):
        wide = base.feeder_wide(spark, str(tmp_path), civil)
        for frame in (wide, base.feeder_weather(spark, str(tmp_path), civil)):
            plan = _plan(frame)
            assert plan.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in plan
        assert sorted(map(str, wide.collect())) == sorted(map(str, pivot_latest(adapters.feeder_measures(spark, str(tmp_path), civil), "arrival").collect()))
