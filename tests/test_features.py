import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattloom.functions.scalars import rounded
from wattloom.plans import features
from wattloom.session import written


@pytest.fixture(scope="module")
def frame(gold):
    return written(features.modelling_frame(gold["fact_demand_hourly"]), "frame")


@pytest.fixture(scope="module")
def built(frame):
    return written(features.build_features(frame), "features")


def test_all_features_are_there_without_null_lags(built):
    assert len(features.FEATURES) == 39 and set(features.FEATURES) <= set(built.columns)
    assert built.where(" or ".join(f"{c} is null" for c in features.LAG_COLUMNS)).count() == 0
    assert built.where("heating_degrees > 0 and cooling_degrees > 0").count() == 0
    assert built.where("heating_degrees < 0 or cooling_degrees < 0").count() == 0


def test_lags_and_rolling_figures_equal_pandas(frame, built):
    source = frame.where("ba_code = 'PJM'").orderBy("period_utc").select("period_utc", "demand_mwh", "temperature_2m").toPandas()
    shifted = source["demand_mwh"].shift(24)
    want = pd.DataFrame(
        {
            "period_utc": source["period_utc"],
            "demand_lag_168h": source["demand_mwh"].shift(168),
            "demand_roll_mean_24h": shifted.rolling(24, min_periods=6).mean(),
            "demand_roll_std_24h": shifted.rolling(24, min_periods=6).std(),
            "demand_roll_mean_168h": shifted.rolling(168, min_periods=42).mean(),
            "demand_roll_std_168h": shifted.rolling(168, min_periods=42).std(),
            "temp_roll_mean_24h": source["temperature_2m"].rolling(24, min_periods=6).mean(),
        }
    )
    got = built.where("ba_code = 'PJM'").orderBy("period_utc").select(*want.columns).toPandas()
    both = got.merge(want, on="period_utc", suffixes=("", "_want"))
    assert len(both) == len(got) > 3000
    for c in want.columns[1:]:
        np.testing.assert_allclose(both[c], both[f"{c}_want"], rtol=1e-9)


def test_rolling_deviation_with_gaps_and_flat_stretches(spark):
    rng = np.random.default_rng(5)
    values = [None if rng.random() < 0.3 else float(rng.normal(1000, 50)) for _ in range(300)]
    values[100:160] = [777.0] * 60
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").selectExpr("'A' as ba_code", "i", "v")
    from wattloom.operators.chunking import over_chunks

    got = over_chunks(rows, ["ba_code"], "i", 60, 0, *features.rolling_steps("v", "roll", 24, (24,)), size=90).orderBy("i").toPandas()
    shifted = pd.Series(values, dtype=float).shift(24).rolling(24, min_periods=6)
    np.testing.assert_allclose(got["roll_mean_24h"], shifted.mean(), rtol=1e-9)
    flat = got["roll_std_24h"].iloc[150:180]
    assert (flat == 0).all()
    past = [[v for v in values[max(0, i - 47): max(0, i - 23)] if v is not None] for i in range(300)]
    exact = np.array([np.std(p, ddof=1) if len(p) >= 6 else np.nan for p in past])
    np.testing.assert_allclose(got["roll_std_24h"], exact, rtol=1e-6, atol=1e-6)


def test_nothing_from_the_last_day_reaches_a_demand_feature(frame, built):
    last = frame.agg(F.max("period_utc")).first()[0]
    changed = frame.withColumn(
        "demand_mwh", F.when(F.col("period_utc") > F.lit(last) - F.expr("interval 23 hours"), F.col("demand_mwh") * 1.05).otherwise(F.col("demand_mwh"))
    )
    columns = [c for c in features.FEATURES if c.startswith("demand")]
    key = ["ba_code", "period_utc"]
    a = rounded(built.select(*key, *columns), 4, *columns)
    b = rounded(features.build_features(changed).select(*key, *columns), 4, *columns)
    assert a.exceptAll(b).count() == 0


def test_future_rows_survive_without_a_target(frame):
    cut = frame.agg(F.max("period_utc")).first()[0]
    future = frame.withColumn("demand_mwh", F.when(F.col("period_utc") <= F.lit(cut) - F.expr("interval 12 hours"), F.col("demand_mwh")))
    kept = features.build_features(future, dropna_target=False)
    assert kept.where("demand_mwh is null").count() >= 36
    assert features.build_features(future).where("demand_mwh is null").count() == 0


def test_cyclical_hours_wrap(built):
    points = {r["hour_local"]: (r["hour_sin"], r["hour_cos"]) for r in built.select("hour_local", "hour_sin", "hour_cos").distinct().collect()}

    def apart(a, b):
        return np.hypot(points[a][0] - points[b][0], points[a][1] - points[b][1])

    assert apart(23, 0) < apart(23, 12)


def test_both_split_conventions(spark):
    rows = spark.sql("select explode(sequence(timestamp'2024-01-01', timestamp'2024-02-10', interval 1 hour)) as period_utc")
    edge = "period_utc = timestamp'2024-01-31'"
    a = features.chronological_split(rows, 10, 10).where(edge).first()["split"]
    b = features.training_split(rows, 10, 10).where(edge).first()["split"]
    assert (a, b) == ("valid", "test")


def test_implausible_rule_uses_the_own_median(spark):
    rows = spark.createDataFrame([("A", 100.0), ("A", 110.0), ("A", 600.0), ("B", 600.0), ("B", 590.0), ("B", None)], "ba_code string, demand_mwh double")
    got = features.flag_implausible(rows).where("flag_implausible").collect()
    assert [(r["ba_code"], r["demand_mwh"]) for r in got] == [("A", 600.0)]


def test_features_are_made_a_chunk_at_a_time(frame):
    """No window runs over the wide rows; the windows left are those over one summary row a (key, chunk)."""
    plan = features.series_features(frame)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan
    assert not any("Window [" in line and "_position" in line for line in plan.splitlines())


def test_chunk_figures_are_those_of_windows(spark):
    """Unknown values, flat stretches, gaps longer than a chunk, border rows and rows without a key, against the window forms."""
    from wattloom.operators.chunking import over_chunk_tables, over_chunks
    from wattloom.operators.series import carried_values, interpolate_gaps

    rng = np.random.default_rng(8)
    rows = []
    for key in ("A", "B"):
        values = [None if rng.random() < 0.3 else float(rng.normal(1000, 50)) for _ in range(400)]
        values[100:160], values[170:300] = [777.0] * 60, [None] * 130
        rows += [(key, i, v) for i, v in enumerate(values)]
    rows = spark.createDataFrame([*rows, (None, 3, 1.0)], "k string, i int, v double")

    def figures(table, edges):
        mean, deviation = features.rolling(*features._known(table, "v"), 24, (24,))[24]
        return {"mean": mean, "deviation": deviation, "lag": features._lag(features._known(table, "v")[0], 48), "near": features.filled(table, edges, "v", 6)}

    carried = carried_values(rows, ["k"], "i", ["v"], 50)
    got = over_chunk_tables(rows, carried, ["k"], "i", 60, 50, ["mean", "deviation", "lag", "near"], figures).orderBy("k", "i")
    windows = over_chunks(
        rows, ["k"], "i", 60, 0, *features.rolling_steps("v", "roll", 24, (24,)), {"lag": "lag(v, 48) over ({w})"}, size=50
    ).join(interpolate_gaps(rows, ["k"], "i", ["v"], 6, 50).withColumnRenamed("v", "near"), ["k", "i"])
    want = windows.selectExpr("k", "i", "v", "roll_mean_24h", "roll_std_24h", "lag", "near").orderBy("k", "i").collect()
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want] and len(want) == 800


def test_rows_without_features_are_those_with_them(frame, built):
    columns = ["ba_code", "period_utc", "demand_mwh"]
    few, all_of_them = features.featured_rows(frame, *columns), built.select(*columns)
    assert few.exceptAll(all_of_them).count() == 0 and few.count() == all_of_them.count()
