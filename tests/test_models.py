import threading

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from wattloom.operators import isolation, metrics
from wattloom.plans import anomaly, bands, features, inference, models
from wattloom.session import written


# ------------------------------------------------------------------ anomalies


def test_seasonal_z_handles_flat_cells(spark):
    rows = [("A", 1, 1, v) for v in (10.0, 11.0, 12.0, 13.0, 100.0)] + [("B", 1, 1, 5.0)] * 3 + [("B", 1, 1, 9.0)]
    df = spark.createDataFrame(rows, "ba_code string, hour_local int, month int, demand_mwh double")
    got = {(r["ba_code"], r["demand_mwh"]): r for r in anomaly.robust_seasonal_z(df).collect()}
    assert got[("A", 100.0)]["robust_z"] == pytest.approx(88 / (1 / 0.6745)) and got[("A", 100.0)]["residual_sign"] == 1
    assert got[("B", 9.0)]["robust_z"] == 0.0


def test_types_first_match_wins_and_votes_make_severity(spark):
    base = dict(
        flag_frozen_reading=False, flag_nonpositive_demand=False, flag_missing_demand=False, flag_extreme_ramp=None,
        ramp_pct=1.0, robust_z=0.0, residual_sign=1.0, iso_flag=False, ae_anomalous_day=False,
    )
    cases = [
        ({}, "normal", "none"),
        ({"flag_frozen_reading": True, "flag_extreme_ramp": True, "robust_z": 9.0}, "frozen_telemetry", "medium"),
        ({"flag_nonpositive_demand": True}, "invalid_reading", "low"),
        ({"flag_extreme_ramp": True, "ramp_pct": -55.0}, "extreme_ramp", "low"),
        ({"ramp_pct": float("inf"), "iso_flag": True}, "extreme_ramp", "low"),
        ({"robust_z": 4.5}, "demand_spike", "low"),
        ({"robust_z": 4.5, "residual_sign": -1.0, "iso_flag": True, "ae_anomalous_day": True}, "demand_drop", "high"),
        ({"ae_anomalous_day": True}, "unusual_daily_shape", "low"),
        ({"iso_flag": True, "ramp_pct": None}, "multivariate_outlier", "low"),
        ({"robust_z": 4.0}, "normal", "none"),
    ]
    kinds = "flag_frozen_reading boolean, flag_nonpositive_demand boolean, flag_missing_demand boolean, flag_extreme_ramp boolean, ramp_pct double, robust_z double, residual_sign double, iso_flag boolean, ae_anomalous_day boolean, n int"
    rows = spark.createDataFrame([tuple({**base, **c[0]}.values()) + (i,) for i, c in enumerate(cases)], kinds).selectExpr(
        "*", "timestamp_seconds(n) as period_utc", "'A' as ba_code", "date'2024-01-01' as date_local", "1 as hour_local",
        "1D as demand_mwh", "1D as temperature_2m", "0D as iso_score", "0D as ae_reconstruction_error",
    )
    got = [(r["anomaly_type"], r["severity"]) for r in anomaly.combine(rows).orderBy("period_utc").collect()]
    assert got == [(t, s) for _, t, s in cases]
    assert anomaly.combine(rows, min_votes=2).where("is_anomaly").count() == 2


def test_forest_finds_planted_outliers_and_flags_the_asked_share(spark):
    rng = np.random.default_rng(7)
    points = rng.normal(0, 1, (3000, 2)).tolist() + [[9.0, 9.0], [-8.0, 10.0], [12.0, -9.0]]
    df = spark.createDataFrame([("A", i, float(a), float(b)) for i, (a, b) in enumerate(points)], "k string, i int, x double, y double")
    forest = isolation.fit_forest(df, ["k", "i"], ["x", "y"], trees=60)
    assert len(forest) == 60 and all(t["size"] == isolation.SAMPLE for t in forest)
    scored = isolation.score(df, ["x", "y"], forest).orderBy(F.desc("iso_score"))
    assert {r["i"] for r in scored.limit(3).collect()} == {3000, 3001, 3002}
    assert isolation.fit_forest(df, ["k", "i"], ["x", "y"], trees=60) == forest  # repeatable
    assert isolation.fit_forest(df.repartition(3), ["k", "i"], ["x", "y"], trees=60) == forest  # whatever the partitions
    assert scored.where("iso_score <= 0 or iso_score >= 1").count() == 0


def test_forest_works_on_fewer_rows_than_it_samples(spark):
    df = spark.range(300).selectExpr("id", "double(id % 17) as x", "case when id = 5 then 500D else double(id % 5) end as y")
    forest = isolation.fit_forest(df, ["id"], ["x", "y"], trees=20)
    assert isolation.score(df, ["x", "y"], forest).orderBy(F.desc("iso_score")).first()["id"] == 5


@pytest.fixture(scope="module")
def scores(gold):
    return written(anomaly.detect(gold["fact_demand_hourly"], trees=40), "anomalies")


def test_detection_end_to_end(gold, scores):
    plausible = gold["fact_demand_hourly"].where("demand_mwh is not null and not flag_implausible_magnitude").count()
    assert scores.columns == anomaly.SCORE_COLUMNS and scores.count() == plausible
    assert scores.where("iso_flag").count() == pytest.approx(0.01 * plausible, rel=0.1)
    assert scores.where("iso_flag and iso_score <= 0").count() == 0
    assert scores.where("(is_anomaly and anomaly_type = 'normal') or (not is_anomaly and anomaly_type <> 'normal')").count() == 0
    days = scores.select("ba_code", "date_local", "ae_anomalous_day").distinct().where("ae_anomalous_day").count()
    assert 1 <= days <= 8
    total = anomaly.summary(scores).first()
    assert total["hours_scored"] == plausible and total["anomalies_found"] == scores.where("is_anomaly").count()


def test_a_strange_day_reconstructs_badly(spark):
    rows = spark.range(600 * 24).selectExpr(
        "'A' as ba_code", "date_add(date'2024-01-01', cast(id div 24 as int)) as date_local", "cast(id % 24 as int) as hour_local",
        """100 + 20 * sin(2 * pi() * (id % 24) / 24) * (1 + (pmod(xxhash64(id div 24), 100L)) / 300D)
           + case when id div 24 = 77 and id % 2 = 0 then 1.2 else 0 end + pmod(xxhash64(id), 100L) / 100D as demand_mwh""",
    )
    worst = anomaly.shape_scores(rows).where("ae_anomalous_day").collect()
    assert str(spark.sql("select date_add(date'2024-01-01', 77)").first()[0]) in {str(r["date_local"]) for r in worst}
    few = rows.where("date_local < date'2024-02-01'")
    assert anomaly.shape_scores(few) is None


# ------------------------------------------------------------------ forecasts


@pytest.fixture(scope="module")
def run(gold):
    frame = features.build_features(written(features.modelling_frame(gold["fact_demand_hourly"]), "frame"))
    return models.train_all(frame, test_days=25, valid_days=20, quick=True, rounds=40)


def test_boosted_model_beats_the_naive_ones(run):
    board = {r["model"]: r for r in run.leaderboard.collect()}
    assert {"gbm", "gbm_hybrid", "ensemble", "seasonal_naive", "weekly_naive", "eia_official"} <= set(board)
    assert board["gbm"]["mape_pct"] < board["weekly_naive"]["mape_pct"]
    assert board["gbm_hybrid"]["mape_pct"] < board["gbm"]["mape_pct"]
    assert board["eia_official"]["skill_vs_eia_pct"] == 0.0
    assert board["gbm"]["p10_p90_coverage_pct"] == pytest.approx(run.coverage_pct, abs=0.01) and 50 < run.coverage_pct < 99


def test_bands_never_cross(run):
    p = run.predictions
    assert p.where("pred_gbm_p10 > pred_gbm_p50 or pred_gbm_p50 > pred_gbm_p90").count() == 0
    assert p.where("pred_gbm_p10 is null").count() == 0


@pytest.fixture(scope="module")
def uneven(spark):
    """Residuals whose spread follows a feature that neither key nor hour shows; even ids train, odd ids test."""
    noise = "pmod(xxhash64(id, 'n'), 1000003L) / 1000003D - 0.5"
    rows = spark.range(24000).selectExpr(
        "id", "cast(id div 2 % 24 as int) as hour", "pmod(xxhash64(id, 'x'), 1009L) / 1009D as x"
    ).selectExpr("*", f"({noise}) * (0.2 + 4 * x) as _residual")
    return written(VectorAssembler(inputCols=["hour", "x"], outputCol="_features").transform(rows), "uneven")


def test_boosted_bands_beat_quantiles_by_hour(spark, uneven):
    train, test = uneven.where("id % 2 = 0"), uneven.where("id % 2 = 1")
    fitted = bands.fit_bands(train, [0.1, 0.9], 32, 60)
    scored = test
    for name, one in zip(("low", "high"), fitted, strict=True):
        assert 1 <= len(one.trees) <= bands.STAGES
        scored = one.attach(scored, name)
    by_hour = train.groupBy("hour").agg(F.expr("percentile(_residual, 0.1)").alias("low_h"), F.expr("percentile(_residual, 0.9)").alias("high_h"))
    loss = "avg(greatest({q} * (_residual - {c}), ({q} - 1) * (_residual - {c})))"
    got = scored.join(by_hour, "hour").selectExpr(
        *[f"{loss.format(q=q, c=c)} as {c}" for c, q in (("low", 0.1), ("low_h", 0.1), ("high", 0.9), ("high_h", 0.9))],
        "100 * avg(cast(_residual between low and high as double)) as inside",
    ).first()
    assert got["low"] < 0.9 * got["low_h"] and got["high"] < 0.9 * got["high_h"]
    assert got["inside"] == pytest.approx(80, abs=3)


def test_saved_bands_are_the_same(spark, uneven, tmp_path):
    fitted = bands.fit_bands(uneven.where("id < 4000"), [0.1, 0.5, 0.9], 32, 60)
    bands.save_bands(spark, fitted, str(tmp_path / "bands"))
    back = bands.load_bands(spark, str(tmp_path / "bands"))
    for one, other in zip(fitted, back, strict=True):
        assert one.attach(uneven, "b").orderBy("id").collect() == other.attach(uneven, "b").orderBy("id").collect()


def test_bands_of_few_rows_are_constants_and_of_none_null(spark, uneven):
    few = bands.fit_quantile(uneven.where("id < 40"), 0.5, 32, 60)
    assert few.trees == [] and few.start is not None
    none = bands.fit_quantile(uneven.where("id < 0"), 0.5, 32, 60)
    assert none.start is None and none.attach(uneven.limit(1), "b").first()["b"] is None


def test_saved_model_predicts_the_same(spark, run, gold, tmp_path):
    run.model.save(str(tmp_path / "model"))
    back = models.Forecaster.load(spark, str(tmp_path / "model"))
    fact, dim = gold["fact_demand_hourly"], gold["dim_ba"]
    first = inference.forecast(fact, dim, run.model).orderBy("ba_code", "period_utc").collect()
    assert first == inference.forecast(fact, dim, back).orderBy("ba_code", "period_utc").collect()
    assert len(first) == 72 and all(r["mode"] == "replay" and r["actual_mwh"] is not None for r in first)
    errors = [abs(r["forecast_mwh"] - r["actual_mwh"]) / r["actual_mwh"] for r in first]
    assert np.mean(errors) < 0.1
    assert run.model.importance(5).count() == 5


def test_live_mode_per_key(run, gold):
    fact, dim = gold["fact_demand_hourly"], gold["dim_ba"]
    last = fact.agg(F.max("period_utc")).first()[0]
    known = fact.where(F.col("period_utc") <= F.lit(last) - F.expr("interval 24 hours"))
    ahead = fact.where(F.col("period_utc") > F.lit(last) - F.expr("interval 24 hours"))
    short = ahead.where("ba_code <> 'CISO'").unionByName(ahead.where("ba_code = 'CISO'").limit(5))
    got = inference.forecast(known, dim, run.model, short)
    counts = {(r["ba_code"], r["mode"]): r["count"] for r in got.groupBy("ba_code", "mode").count().collect()}
    assert counts == {("PJM", "live"): 24, ("ERCO", "live"): 24, ("CISO", "replay"): 24}
    assert got.where("mode = 'live' and actual_mwh is not null").count() == 0


def test_unknown_key_uses_global_figures(spark):
    from wattloom.operators.windows import scale_target, unscale

    stats = spark.createDataFrame([("A", 100.0, 10.0)], "ba_code string, centre double, spread double")
    overall = spark.createDataFrame([(50.0, 5.0)], "centre double, spread double")
    rows = spark.createDataFrame([("A", 120.0), ("Z", 60.0)], "ba_code string, demand_mwh double")
    z = scale_target(rows, stats, overall)
    assert {r["ba_code"]: r["target_z"] for r in z.collect()} == {"A": 2.0, "Z": 2.0}
    assert {r["target_z"] for r in unscale(z, stats, overall, ["target_z"]).collect()} == {120.0, 60.0}


def test_flat_series_get_a_spread(spark):
    from wattloom.operators.windows import target_stats

    rows = spark.createDataFrame([("A", 200.0)] * 5 + [("B", 2.0)] * 5, "ba_code string, demand_mwh double")
    assert {r["ba_code"]: r["spread"] for r in target_stats(rows).collect()} == {"A": 20.0, "B": 1.0}


def test_reconciled_windows(spark):
    rows = spark.sql("select * from values ('A', timestamp'2024-01-01', 1D), ('A', timestamp'2024-01-01', 3D) as t(ba_code, period_utc, prediction)")
    row = metrics.reconcile(rows).first()
    assert (row["prediction"], row["n_windows"]) == (2.0, 2)


def test_bands_take_one_pass_a_stage(uneven, monkeypatch):
    """A stage looks for the shifts of all quantiles at once, and finds what each would find alone."""
    passes = []
    real = bands.grouped_quantiles
    monkeypatch.setattr(bands, "grouped_quantiles", lambda *a: passes.append(a[1]) or real(*a))
    rows = uneven.where("id < 4000")
    pair = bands.fit_bands(rows, [0.1, 0.9], 32, 60, stages=2)
    assert len(passes) == 3 and all(len(b.trees) == 2 for b in pair)
    alone = bands.fit_quantile(rows, 0.9, 32, 60, stages=2)
    assert (alone.start, alone.shifts) == (pair[1].start, pair[1].shifts)


def test_baselines_are_written_while_the_models_train(spark, monkeypatch):
    """No fit ends before the test rows are there; they are those of the baselines over whole rows."""
    hours = spark.range(2 * 24 * 40).selectExpr("concat('K', id % 2) as ba_code", "id div 2 as h", "100D + pmod(xxhash64(id), 50L) as demand_mwh")
    frame = hours.selectExpr(
        "timestamp_seconds(h * 3600) as period_utc", "ba_code", "demand_mwh", "demand_mwh + 1 as demand_forecast_mwh", "'x' as date_local",
        *[f"demand_mwh + {i} as {c}" for i, c in enumerate(features.FEATURES)],
    )
    tables, there, real = {}, threading.Event(), models.written

    class FitEnded(Exception):
        pass

    def noted(df, name):
        tables[name] = real(df, name)
        if name == "baselines":
            there.set()
        return tables[name]

    def fit(*_, **__):
        assert there.wait(60)
        raise FitEnded

    monkeypatch.setattr(models, "written", noted)
    monkeypatch.setattr(models, "fit_forecaster", fit)
    with pytest.raises(FitEnded):
        models.train_all(frame, test_days=5, valid_days=5)
    whole = models.build_all_baselines(tables["features"]).where("split = 'test'").drop("split", "pred_drift_naive")
    got = tables["baselines"].select(whole.columns).orderBy("ba_code", "period_utc").collect()
    assert len(got) == 2 * (24 * 5 + 1) and got == whole.orderBy("ba_code", "period_utc").collect()
