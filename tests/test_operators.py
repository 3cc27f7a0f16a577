import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattloom.functions.scalars import half_up, hour_number
from wattloom.operators.chunking import over_chunks, with_ordinal, with_previous
from wattloom.operators.quantiles import grouped_quantiles
from wattloom.operators.series import hourly_spine, interpolate_gaps, merge_weather, pivot_latest, pivot_measures, upsert_measures
from wattloom.operators.windows import sliding_windows


def hourly(spark, values, key="A", start="2024-01-01"):
    """A gap-free series; None is a missing value."""
    rows = [(key, i, None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "ba_code string, i int, v double").selectExpr(
        "ba_code", "i", f"timestamp'{start}' + make_interval(0,0,0,0,i,0,0) as period_utc", "v"
    )


def in_order(df, column, order="i"):
    return [r[0] for r in df.orderBy(order).select(column).collect()]


@pytest.mark.parametrize("size", [5, 17, 1000])
def test_chunked_windows_equal_one_window(spark, size):
    rng = np.random.default_rng(1)
    values = [None if rng.random() < 0.2 else float(rng.integers(0, 50)) for _ in range(120)]
    df = hourly(spark, values)
    got = over_chunks(
        df, ["ba_code"], "i", 4, 2,
        {"back": "lag(v, 4) over ({w})", "near": "avg(v) over ({w} rows between 3 preceding and 2 following)"},
        size=size,
    )
    want = df.selectExpr(
        "*", "lag(v, 4) over (partition by ba_code order by i) as back",
        "avg(v) over (partition by ba_code order by i rows between 3 preceding and 2 following) as near",
    )
    assert got.orderBy("i").collect() == want.select(*got.columns).orderBy("i").collect()


def test_ordinals_and_previous_values_across_long_gaps(spark):
    rng = np.random.default_rng(2)
    at = sorted(set(rng.integers(0, 5000, 200).tolist()) | {4999})
    rows = [(k, int(t), float(t % 7)) for k in ("A", "B") for t in at]
    df = spark.createDataFrame(rows, "ba_code string, t int, v double").selectExpr(
        "*", "timestamp'2024-01-01' + make_interval(0,0,0,0,t,0,0) as period_utc"
    )
    got = with_previous(with_ordinal(df, ["ba_code"], "period_utc", hours=24), ["ba_code"], "period_utc", "v", "p", hours=24)
    want = df.selectExpr(
        "ba_code", "t", "row_number() over (partition by ba_code order by t) - 1 as ordinal",
        "lag(v) over (partition by ba_code order by t) as p",
    )
    key = ["ba_code", "t"]
    assert got.select(*key, "ordinal", "p").orderBy(*key).collect() == want.orderBy(*key).collect()


def test_quantiles_are_exact_under_skew(spark):
    rng = np.random.default_rng(3)
    groups = {
        "hot": rng.lognormal(8, 2, 5000), "small": np.array([3.0]), "signed": rng.normal(0, 100, 501),
        "flat": np.zeros(40), "pairs": np.repeat([1.0, 2.0], 50),
    }
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("small", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    probs = {"p1": 0.01, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r["k"]: r for r in grouped_quantiles(df, ["k"], "v", probs).collect()}
    for k, vs in groups.items():
        for name, p in probs.items():
            assert got[k][name] == pytest.approx(np.quantile(vs, p), rel=1e-12, abs=1e-12), (k, name)
    every = np.concatenate(list(groups.values()))
    assert grouped_quantiles(df, [], "v", {"m": 0.5}).first()["m"] == pytest.approx(np.median(every))


@pytest.mark.parametrize("size", [4, 7, 500])
def test_gap_filling_equals_pandas(spark, size):
    pattern = [None] * 8 + [1.0] + [None] * 3 + [5.0] + [None] * 8 + [2.0] + [None] * 13 + [9.0] + [None] * 15 + [4.0, 6.0] + [None] * 9
    df = hourly(spark, pattern)
    got = in_order(interpolate_gaps(df, ["ba_code"], hour_number(), ["v"], size=size), "v")
    want = pd.Series(pattern, dtype=float).interpolate(limit=6, limit_direction="both")
    assert [x is None for x in got] == want.isna().tolist()
    np.testing.assert_allclose(np.array(got, dtype=float), want.to_numpy(), rtol=1e-12)


def test_a_series_without_values_stays_empty(spark):
    got = interpolate_gaps(hourly(spark, [None] * 10), ["ba_code"], hour_number(), ["v"])
    assert in_order(got, "v") == [None] * 10


def test_upsert_keeps_the_newest_and_fused_pivot_agrees(spark):
    rows = [
        ("A", 0, "D", 1.0, 1), ("A", 0, "D", 2.0, 3), ("A", 0, "D", 9.0, 2), ("A", 0, "DF", 5.0, 1),
        ("A", 1, "D", 7.0, 1), ("A", 1, "D", None, 2), ("A", 1, "XX", 4.0, 9),
    ]
    df = spark.createDataFrame(rows, "ba_code string, h int, measure_code string, value_mwh double, n int").selectExpr(
        "timestamp'2024-01-01' + make_interval(0,0,0,0,h,0,0) as period_utc", "ba_code", "measure_code", "value_mwh",
        "timestamp'2024-02-01' + make_interval(0,0,0,0,n,0,0) as ingested_at_utc",
    )
    early, late = df.where("ingested_at_utc < timestamp'2024-02-01 02:00:00'"), df.where("ingested_at_utc >= timestamp'2024-02-01 02:00:00'")
    merged = upsert_measures(early, late)
    assert merged.count() == 4
    assert upsert_measures(merged, late).count() == 4
    wide = pivot_measures(merged).orderBy("period_utc").collect()
    assert [(r["demand_mwh"], r["demand_forecast_mwh"]) for r in wide] == [(2.0, 5.0), (None, None)]
    assert pivot_latest(df, "ingested_at_utc").orderBy("period_utc").collect() == wide


def test_archive_weather_beats_a_newer_forecast(spark):
    def record(source, temp, day):
        return spark.sql(
            f"select timestamp'2024-01-01' as period_utc, {temp}D as temperature_2m, 'A' as ba_code, '{source}' as source, "
            f"timestamp'2024-02-{day:02d}' as ingested_at_utc"
        )

    merged = merge_weather(record("era5_archive", 1, 1), record("forecast", 2, 9), record("era5_archive", 3, 5))
    assert merged.select("temperature_2m").collect() == [(3.0,)]


def test_spine_is_continuous_for_long_and_short_series(spark):
    bounds = spark.sql("select 'A' as ba_code, timestamp'2019-12-31 05:00:00' as lo, timestamp'2020-12-31 05:00:00' as hi "
                       "union all select 'B', timestamp'2020-03-08 06:00:00', timestamp'2020-03-08 06:00:00'")
    spine = hourly_spine(bounds)
    counts = {r["ba_code"]: (r["n"], r["d"], r["hours"]) for r in spine.groupBy("ba_code").agg(
        F.count("*").alias("n"), F.countDistinct("period_utc").alias("d"),
        ((F.unix_seconds(F.max("period_utc")) - F.unix_seconds(F.min("period_utc"))) / 3600 + 1).alias("hours"),
    ).collect()}
    assert counts == {"A": (8785, 8785, 8785.0), "B": (1, 1, 1.0)}


def test_half_up_rounds_away_from_zero_whatever_the_noise(spark):
    row = spark.sql(f"select {half_up('1.005D', 2)}, {half_up('2.5D')}, {half_up('-2.5D')}, {half_up('0.1D + 0.2D + 2.2D')}").first()
    assert list(row) == [1.01, 3.0, -3.0, 3.0]


def test_sliding_windows_hold_the_right_rows(spark):
    n = 168 + 24 + 40
    df = hourly(spark, range(n)).selectExpr("ba_code", "period_utc", "v", "v as c")
    found = sliding_windows(
        df, "timestamp'2024-01-08'", "timestamp'2024-01-09'", past=["v"], future=["c"], target="v"
    ).orderBy("start").collect()
    by_split = {s: [r["start"] for r in found if r["split"] == s] for s in ("train", "valid", "test")}
    assert by_split == {"train": [], "valid": [0, 12], "test": [24, 30, 36]}
    first = found[0]
    assert [x[0] for x in first["past"]] == list(range(0, 168, 3))
    assert [x[0] for x in first["future"]] == list(range(168, 192)) and list(first["target"]) == list(range(168, 192))
    gap = df.where("v <> 100")
    assert sliding_windows(gap, "timestamp'2024-01-08'", "timestamp'2024-01-09'", past=["v"], future=["c"], target="v").count() > 0
    contiguous = sliding_windows(
        gap, "timestamp'2024-01-08'", "timestamp'2024-01-09'", past=["v"], future=["c"], target="v", require_contiguous=True
    )
    assert contiguous.count() == 0


def test_keys_of_any_length_stay_apart(spark):
    from wattloom.sources.adapters import feeder_code

    codes = [spark.sql(f"select {feeder_code(str(n))} as c").first()["c"] for n in (7, 999_999, 1_234_567, 1_234_568, 12_345_678)]
    assert codes == ["BA000007", "BA999999", "BA1234567", "BA1234568", "BA12345678"]


def test_quantiles_of_tiny_and_crowded_values(spark):
    import numpy as np

    from wattloom.operators.quantiles import grouped_quantiles

    draw = np.random.default_rng(5)
    sets = {
        "tiny": 10 ** draw.uniform(-9, -3, 3000),
        "crowded": 1 + draw.normal(size=3000) * 1e-9,
        "signs": np.concatenate([-(10 ** draw.uniform(-300, 300, 500)), [0.0, 0.0], 10 ** draw.uniform(-300, 300, 500)]),
        "same": np.full(100, 2.5),
    }
    rows = [(k, float(x)) for k, v in sets.items() for x in v]
    wanted = {"a": 0.0, "b": 0.01, "c": 0.5, "d": 0.99, "e": 1.0}
    found = grouped_quantiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", wanted).collect()
    assert len(found) == len(sets)
    for row in found:
        assert [row[n] for n in wanted] == pytest.approx([float(np.quantile(sets[row["k"]], q)) for q in wanted.values()], rel=1e-12)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_wins_hashes_fixed_width_rows(spark):
    """The packed key sorts as the struct does, nulls first, and no aggregate of the merges sorts its rows."""
    from wattloom.operators.series import latest_wins, order_key, pivot_latest, upsert_measures, weather_latest
    from wattloom.schemas import WEATHER

    odd = spark.sql(
        """select * from values (true, timestamp'2024-01-01', 5L), (true, timestamp'2024-01-01', -5L), (false, timestamp'9998-12-31', 9223372036854775807L),
           (null, timestamp'0002-01-01', -9223372036854775808L), (true, null, 0L), (true, timestamp'2024-01-01', null), (false, timestamp'1969-12-31 23:59:59.999999', 0L) as t(b, t, n)"""
    )
    key = order_key(odd, "struct(b, t, n)")
    assert key != "struct(b, t, n)"
    plain = [tuple(r) for r in odd.orderBy("b", "t", "n").collect()]
    assert [tuple(r) for r in odd.orderBy(F.expr(key)).collect()] == plain and odd.selectExpr(f"count(distinct {key})").first()[0] == 7
    assert order_key(odd, "struct(cast(t as string), n)") == "struct(cast(t as string), n)" and order_key(odd, "t") == "t"
    assert order_key(odd, "struct(n, n as m)") == "struct(n, n as m)"  # more than 38 digits

    rows = spark.range(4000).selectExpr(
        "timestamp_seconds((id % 50) * 3600) as period_utc", "concat('B', id % 3) as ba_code", "element_at(array('D', 'DF', 'NG', 'TI'), cast(id % 4 as int) + 1) as measure_code",
        "if(id % 7 = 0, null, cast(id as double)) as value_mwh", "timestamp_seconds(pmod(xxhash64(id), 20)) as ingested_at_utc", "id as seq",
        *[f"cast(id as double) as {c}" for c in WEATHER], "id % 2 = 0 as archived",
    )
    measures = rows.select("period_utc", "ba_code", "measure_code", "value_mwh", "ingested_at_utc", "seq")
    merged, wide = upsert_measures(None, measures, ["seq"]), pivot_latest(measures, "struct(ingested_at_utc, seq)")
    weather = weather_latest(rows, "struct(archived, ingested_at_utc, seq)")
    for frame in (merged, wide, weather):
        assert "HashAggregate" in _plan(frame) and "SortAggregate" not in _plan(frame) and "ObjectHashAggregate" not in _plan(frame)
    measures.createOrReplaceTempView("all_measures")
    ranked = spark.sql("select *, row_number() over (partition by ba_code, period_utc, measure_code order by ingested_at_utc desc, seq desc) as place from all_measures")
    assert sorted(map(str, merged.collect())) == sorted(map(str, ranked.where("place = 1").drop("place").collect()))
    named = latest_wins(measures.withColumn("note", F.lit("x")), ["ba_code", "period_utc", "measure_code"], ["ingested_at_utc", "seq"])
    assert sorted(map(str, named.drop("note").collect())) == sorted(map(str, merged.collect()))


def test_sliding_windows_over_chunk_borders(spark):
    """Every window of a series of several chunks, a short one and one with a gap, against a loop."""
    from wattloom.operators.chunking import chunk_size

    n = 2 * chunk_size(168, 24) + 300
    df = hourly(spark, range(n)).selectExpr("ba_code", "period_utc", "v", "-v as c").where("v <> 777")
    short = hourly(spark, range(150)).selectExpr("'shrt' as ba_code", "period_utc", "v", "v as c")
    found = sliding_windows(df.unionByName(short), "timestamp'2024-03-01'", "timestamp'2024-05-01'", past=["v", "c"], future=["c"], target="v")
    rows = sorted((r["period_utc"], r["v"]) for r in df.collect())
    splits = ["train" if str(p) < "2024-03-01" else "valid" if str(p) < "2024-05-01" else "test" for p, _ in rows]
    expected = []
    for split, stride in (("train", 12), ("valid", 12), ("test", 6)):
        own = [i for i in range(168, len(rows)) if splits[i] == split]
        for first in range(own[0], own[-1] + 1, stride):
            if first + 24 <= len(rows):
                past = [[rows[i][1], -rows[i][1]] for i in range(first - 168, first, 3)]
                expected.append((split, first - 168, rows[first][0], past, [[-v] for _, v in rows[first : first + 24]], [v for _, v in rows[first : first + 24]]))
    got = [(r["split"], r["start"], r["horizon_start"], r["past"], r["future"], r["target"]) for r in found.collect()]
    assert sorted(got, key=lambda g: g[1]) == sorted(expected, key=lambda g: g[1])


def test_windows_are_packed_by_a_bounded_number_of_rows_a_task(spark, monkeypatch):
    from wattloom.operators import windows

    monkeypatch.setattr(windows, "ROWS_A_TASK", 50)
    frame = hourly(spark, [float(i) for i in range(1000)]).withColumnRenamed("v", "target_z")
    found = sliding_windows(frame, "timestamp'2024-01-20'", "timestamp'2024-02-01'", 48, 24, ["target_z"], ["target_z"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(ba_code" in plan and ", 20), REPARTITION_BY_NUM" in plan
    assert all(r["target"] == [float(r["start"] + 48 + i) for i in range(24)] and r["past"][1] == [float(r["start"] + 3)] for r in found.collect())
