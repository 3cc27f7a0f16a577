import math

import pytest

from wattloom.operators import metrics
from wattloom.plans.baselines import build_all_baselines, seasonal_mean
from wattloom.plans.diagnostics import error_concentration


def pairs(spark, actual, predicted, **more):
    rows = list(zip(actual, predicted, strict=True))
    return spark.createDataFrame(rows, "actual double, predicted double")


def test_perfect_and_ten_percent(spark):
    assert metrics.evaluate(pairs(spark, [100.0, 200.0, 300.0], [100.0, 200.0, 300.0]), []).first()["mape_pct"] == 0
    row = metrics.evaluate(pairs(spark, [100.0, 200.0, 300.0], [110.0, 220.0, 330.0]), []).first()
    assert row["mape_pct"] == 10.0 and row["n_obs"] == 3 and row["mae_mwh"] == 20.0


def test_only_finite_positive_rows_count(spark):
    row = metrics.evaluate(pairs(spark, [100.0, math.nan, 0.0, 200.0, None], [110.0, 150.0, 50.0, 180.0, 1.0]), []).first()
    assert row["n_obs"] == 2 and row["mape_pct"] == 10.0


def test_r2_is_unknown_for_a_flat_actual(spark):
    assert metrics.evaluate(pairs(spark, [5.0, 5.0], [4.0, 6.0]), []).first()["r2"] is None


def test_coverage_counts_both_ends(spark):
    df = spark.createDataFrame([(10.0, 5.0, 15.0), (10.0, 10.0, 12.0), (10.0, 3.0, 10.0), (10.0, 11.0, 12.0), (10.0, None, 1.0)], "actual double, lo double, hi double")
    assert metrics.coverage(df, [], "lo", "hi").first()["coverage_pct"] == 75.0


def test_pinball_punishes_the_right_side(spark):
    under = metrics.pinball_loss(pairs(spark, [100.0], [90.0]), [], 0.9).first()[0]
    over = metrics.pinball_loss(pairs(spark, [100.0], [110.0]), [], 0.9).first()[0]
    assert under == pytest.approx(9.0) and over == pytest.approx(1.0)


@pytest.mark.parametrize(("model", "benchmark", "want"), [("1.5D", "2.0D", 25.0), ("1.5D", "0D", None), ("double('NaN')", "2D", None), ("3D", "2D", -50.0)])
def test_skill(spark, model, benchmark, want):
    assert spark.sql(f"select {metrics.skill('m', 'b')} from (select {model} as m, {benchmark} as b)").first()[0] == want


def test_peak_row_is_the_first_of_equals_over_all_keys(spark):
    df = spark.sql("""select * from values (timestamp'2024-01-01 05:00:00', 'B', 10D, 1D), (timestamp'2024-01-01 09:00:00', 'A', 10D, 2D),
        (timestamp'2024-01-01 03:00:00', 'A', 4D, 3D), (timestamp'2024-01-02 03:00:00', 'B', 7D, 7D) as t(period_utc, ba_code, actual, predicted)""")
    assert sorted(r["predicted"] for r in metrics.peak_rows(df, []).collect()) == [2.0, 7.0]
    assert metrics.peak_rows(df, [], per_key=True).count() == 3


def test_leaderboard_ranks_skips_and_compares(spark):
    rows = spark.range(200).selectExpr(
        "timestamp'2024-01-01' + make_interval(0,0,0,0,cast(id as int),0,0) as period_utc", "'A' as ba_code", "100D + id % 24 as demand_mwh",
        "(100D + id % 24) * 1.02 as pred_eia_official", "(100D + id % 24) * 1.01 as pred_good",
        "case when id < 50 then 1D end as pred_rare",
    )
    board = metrics.leaderboard(rows)
    by_model = {r["model"]: r for r in board.collect()}
    assert set(by_model) == {"eia_official", "good"}
    assert by_model["good"]["skill_vs_eia_pct"] == 50.0 and by_model["eia_official"]["skill_vs_eia_pct"] == 0.0
    assert metrics.headline(board).first()["best_model"] == "good"
    assert {r["model"] for r in metrics.leaderboard(rows, min_rows=10, common_rows=True).select("model", "n_obs").where("n_obs = 50").collect()} == {"eia_official", "good", "rare"}


def test_baselines_count_rows_or_hours(spark):
    rows = spark.range(400).where("id <> 100").selectExpr(
        "'A' as ba_code", "timestamp'2024-01-01' + make_interval(0,0,0,0,cast(id as int),0,0) as period_utc", "double(id) as demand_mwh"
    )
    at = "period_utc = timestamp'2024-01-06 00:00:00'"  # hour 120; hour 100 was dropped
    assert build_all_baselines(rows).where(at).first()["pred_seasonal_naive"] == 95.0
    assert build_all_baselines(rows, time_exact=True).where(at).first()["pred_seasonal_naive"] == 96.0
    drift = build_all_baselines(rows).where("period_utc = timestamp'2024-01-16 00:00:00'").first()["pred_drift_naive"]
    assert drift == pytest.approx(192 + 0.5 * 168 - 0.5, abs=1)


def test_seasonal_mean_repeats_the_phase(spark):
    rows = spark.range(24 * 6).selectExpr(
        "'A' as ba_code", "timestamp'2024-01-01' + make_interval(0,0,0,0,cast(id as int),0,0) as period_utc", "double(id % 24) as demand_mwh"
    )
    got = [r["forecast_mwh"] for r in seasonal_mean(rows, 30).orderBy("horizon_step").collect()]
    assert got == [float(i % 24) for i in range(30)]


def test_error_concentration_counts_ties_once(spark):
    rows = spark.range(200).selectExpr("100D as demand_mwh", "case when id < 5 then 150D else 101D end as p")
    got = error_concentration(rows, "p", 0.01).first()
    assert got["worst_share_pct"] == pytest.approx(2 * 50 / (5 * 50 + 195) * 100)
    assert got["median_ape_pct"] == pytest.approx(1.0)


def test_holt_winters_follows_trend_and_season_and_falls_back(spark):
    from wattloom.operators.smoothing import holt_winters

    rows = spark.range(24 * 30).selectExpr(
        "'A' as ba_code", "id", "timestamp'2024-01-01' + make_interval(0,0,0,0,cast(id as int),0,0) as period_utc",
        "1000 + 0.5 * id + 100 * sin(2 * pi() * (id % 24) / 24) as demand_mwh",
    )
    few = rows.where("id < 60").selectExpr("'B' as ba_code", "id", "period_utc", "double(id % 24) as demand_mwh")
    got = holt_winters(rows.unionByName(few), 24)
    ahead = {r["horizon_step"]: r["forecast_mwh"] for r in got.where("ba_code = 'A'").collect()}
    for step, value in ahead.items():
        i = 24 * 30 + step - 1
        assert value == pytest.approx(1000 + 0.5 * i + 100 * math.sin(2 * math.pi * (i % 24) / 24), rel=0.01)
    assert {r["method"] for r in got.where("ba_code = 'B'").collect()} == {"seasonal_mean"} and got.count() == 48


def test_holt_winters_weights_are_never_worse_than_the_grid():
    import itertools

    import numpy as np

    from wattloom.operators import smoothing

    draw = np.random.default_rng(3)
    hours = np.arange(24 * 20)
    grid = np.array(list(itertools.product(smoothing.LEVEL, smoothing.TREND, smoothing.SEASON)))
    for noise, drift in ((0.0, 0.0), (3.0, 0.1), (12.0, 0.0)):
        values = 100 + drift * hours + 20 * np.sin(2 * np.pi * hours / 24) + np.cumsum(draw.normal(0, 0.3 * noise, len(hours))) + draw.normal(0, noise, len(hours))
        best = smoothing.fitted_weights(values, 24)
        assert (best >= 0).all() and (best <= 1).all()
        error, least = smoothing.fold(values, 24, best[None])[0][0], smoothing.fold(values, 24, grid)[0].min()
        assert error <= least and (noise == 0 or error < least)
    # weights the series was made with are found again, nearly
    level, season = 120.0, np.zeros(24)
    made = []
    for t in range(24 * 60):
        shock = draw.normal()
        made.append(level + season[t % 24] + shock)
        level, season[t % 24] = level + 0.33 * shock, season[t % 24] + 0.12 * (1 - 0.33) * shock
    assert abs(smoothing.fitted_weights(np.array(made), 24)[0] - 0.33) < 0.1
