"""Baselines, metrics and leaderboard."""

from __future__ import annotations

from wattloom.catalogue.base import feeder_gold, r, register, view
from wattloom.catalogue.features import written_frame
from wattloom.functions.scalars import exprs, half_up, rounded, row_mean, sorted_row
from wattloom.operators import metrics
from wattloom.plans import baselines, features
from wattloom.session import written

_W = "OVER (PARTITION BY ba_code ORDER BY period_utc)"
view(
    "feed_baselines",
    f"""
    SELECT period_utc, ba_code, demand_mwh, demand_forecast_mwh, lag(demand_mwh, 24) {_W} AS pred_seasonal_naive,
           lag(demand_mwh, 168) {_W} AS pred_weekly_naive,
           lag(demand_mwh, 168) {_W} + 0.5::DOUBLE * (lag(demand_mwh, 168) {_W} - lag(demand_mwh, 336) {_W}) AS pred_drift_naive,
           demand_forecast_mwh AS pred_eia_official
    FROM feed_features
    """,
)
PREDS = ["pred_seasonal_naive", "pred_weekly_naive", "pred_drift_naive", "pred_eia_official"]


def feeder_baselines(spark, sf_dir):
    frame = features.featured_rows(written_frame(spark, sf_dir), "period_utc", "ba_code", "demand_mwh", "demand_forecast_mwh")
    return baselines.build_all_baselines(written(frame, "features"))


def _rounded_preds(df):
    return rounded(df, 4, *PREDS)


_ROUND = ", ".join(f"{r(c, 4)} AS {c}" for c in PREDS)
register("baselines", f"SELECT * REPLACE ({_ROUND}) FROM feed_baselines")(lambda s, d: _rounded_preds(feeder_baselines(s, d)))


@register(
    "baselines_time_exact",
    f"""
    SELECT * REPLACE ({_ROUND}) FROM (
        SELECT f.period_utc, f.ba_code, f.demand_mwh, f.demand_forecast_mwh, a.demand_mwh AS pred_seasonal_naive,
               b.demand_mwh AS pred_weekly_naive,
               b.demand_mwh + 0.5::DOUBLE * (b.demand_mwh - c.demand_mwh) AS pred_drift_naive,
               f.demand_forecast_mwh AS pred_eia_official
        FROM feed_features f
        LEFT JOIN feed_features a ON a.ba_code = f.ba_code AND a.period_utc = f.period_utc - INTERVAL 24 HOUR
        LEFT JOIN feed_features b ON b.ba_code = f.ba_code AND b.period_utc = f.period_utc - INTERVAL 168 HOUR
        LEFT JOIN feed_features c ON c.ba_code = f.ba_code AND c.period_utc = f.period_utc - INTERVAL 336 HOUR)
    """,
)
def _time_exact(spark, sf_dir):
    frame = features.featured_rows(written_frame(spark, sf_dir), "period_utc", "ba_code", "demand_mwh", "demand_forecast_mwh")
    return _rounded_preds(baselines.build_all_baselines(written(frame, "features"), time_exact=True))


register(
    "seasonal_mean_forecast",
    f"""
    WITH known AS (SELECT *, row_number() OVER (PARTITION BY ba_code ORDER BY period_utc DESC) AS back
                   FROM feed_model WHERE demand_mwh IS NOT NULL),
         tail AS (SELECT *, count(*) OVER (PARTITION BY ba_code) - back AS idx,
                         max(period_utc) OVER (PARTITION BY ba_code) AS last_period FROM known WHERE back <= 96),
         pattern AS (SELECT ba_code, idx % 24 AS phase, avg(demand_mwh) AS v, max(last_period) AS last_period
                     FROM tail GROUP BY 1, 2)
    SELECT ba_code, last_period + to_hours(step) AS period_utc, CAST(step AS INTEGER) AS horizon_step, {r('v', 4)} AS forecast_mwh
    FROM pattern JOIN (SELECT unnest(generate_series(1, 36)) AS step) ON (step - 1) % 24 = phase
    """.replace("WITH known", "SELECT * FROM (WITH known") + ")",
)(lambda s, d: rounded(baselines.seasonal_mean(_model_frame(s, d), 36), 4, "forecast_mwh"))


def _model_frame(spark, sf_dir):
    return features.modelling_frame(feeder_gold(spark, sf_dir)["fact_demand_hourly"])


def _bundle_sql(actual, predicted):
    e = f"({actual} - {predicted})"
    return f"""{r(f'avg(abs({e} / {actual})) * 100', 4)} AS mape_pct,
        {r(f'avg(abs({e}) / ((abs({actual}) + abs({predicted})) / 2)) * 100', 4)} AS smape_pct,
        {r(f'avg(abs({e}))', 2)} AS mae_mwh, {r(f'sqrt(avg({e} * {e}))', 2)} AS rmse_mwh,
        {r(f'1 - sum({e} * {e}) / nullif(var_pop({actual}) * count(*), 0)', 5)} AS r2, count(*) AS n_obs"""


view(
    "board_long",
    " UNION ALL ".join(
        f"SELECT period_utc, ba_code, demand_mwh AS actual, {c} AS predicted, '{c.removeprefix('pred_')}' AS model "
        f"FROM feed_baselines WHERE {c} IS NOT NULL AND demand_mwh IS NOT NULL"
        for c in PREDS
    ),
)
view(
    "board_scores",
    f"""
    SELECT model, {_bundle_sql('actual', 'predicted')} FROM board_long WHERE actual > 0 GROUP BY model
    """,
)
view(
    "board_peaks",
    f"""
    SELECT model, {r('avg(abs((actual - predicted) / actual)) * 100', 4)} AS peak_hour_mape_pct
    FROM (SELECT *, row_number() OVER (PARTITION BY model, CAST(period_utc AS DATE)
                                       ORDER BY actual DESC, ba_code, period_utc) AS rn FROM board_long)
    WHERE rn = 1 GROUP BY model
    """,
)
view(
    "board",
    f"""
    SELECT s.*, p.peak_hour_mape_pct, b.mape_pct AS benchmark_mape_pct,
           {r('(b.mape_pct - s.mape_pct) / b.mape_pct * 100', 2)} AS skill_vs_eia_pct
    FROM board_scores s JOIN board_peaks p USING (model)
    CROSS JOIN (SELECT mape_pct FROM board_scores WHERE model = 'eia_official') b
    WHERE model IN (SELECT model FROM board_long GROUP BY model HAVING count(*) >= 100)
    """,
)


def feeder_board(spark, sf_dir):
    return metrics.leaderboard(written(feeder_baselines(spark, sf_dir), "predictions"))


register("leaderboard", "SELECT * FROM board")(feeder_board)
register(
    "headline",
    """SELECT model AS best_model, mape_pct AS best_mape_pct, benchmark_mape_pct AS eia_benchmark_mape_pct,
              skill_vs_eia_pct, n_obs AS test_observations, TIMESTAMP '2023-01-15' AS test_window_start, TIMESTAMP '2023-03-01' AS generated_at_utc
       FROM board ORDER BY mape_pct, model LIMIT 1""",
)(lambda s, d: metrics.headline(feeder_board(s, d), "timestamp'2023-01-15'", "timestamp'2023-03-01'"))

_PAIRS = "FROM feed_accuracy WHERE actual_mwh > 0"


def _accuracy(spark, sf_dir):
    return feeder_gold(spark, sf_dir)["fact_forecast_accuracy"]


register("metric_bundle", f"SELECT ba_code, {_bundle_sql('actual_mwh', 'eia_forecast_mwh')} {_PAIRS} GROUP BY ba_code")(
    lambda s, d: metrics.evaluate(_accuracy(s, d), ["ba_code"], "actual_mwh", "eia_forecast_mwh")
)
register(
    "pinball_loss",
    f"""SELECT ba_code, {r('avg(greatest(0.9::DOUBLE * (actual_mwh - eia_forecast_mwh), -0.1::DOUBLE * (actual_mwh - eia_forecast_mwh)))', 4)}
        AS pinball_loss {_PAIRS} GROUP BY ba_code""",
)(
    lambda s, d: rounded(
        metrics.pinball_loss(_accuracy(s, d), ["ba_code"], 0.9, "actual_mwh", "eia_forecast_mwh"), 4, "pinball_loss"
    )
)
register(
    "interval_coverage",
    f"""SELECT ba_code, {r('avg(CASE WHEN actual_mwh BETWEEN eia_forecast_mwh * 0.97::DOUBLE AND eia_forecast_mwh * 1.03::DOUBLE THEN 1.0 ELSE 0.0 END) * 100', 4)}
        AS coverage_pct FROM feed_accuracy GROUP BY ba_code""",
)(
    lambda s, d: rounded(
        metrics.coverage(
            _accuracy(s, d).selectExpr("*", "eia_forecast_mwh * 0.97D as lo", "eia_forecast_mwh * 1.03D as hi"),
            ["ba_code"], "lo", "hi", "actual_mwh",
        ),
        4, "coverage_pct",
    )
)
register(
    "peak_hour_mape",
    f"""SELECT {r('avg(abs((actual_mwh - eia_forecast_mwh) / actual_mwh)) * 100', 4)} AS peak_hour_mape_pct
        FROM (SELECT *, row_number() OVER (PARTITION BY CAST(period_utc AS DATE) ORDER BY actual_mwh DESC, ba_code, period_utc) AS rn
              FROM feed_accuracy) WHERE rn = 1""",
)(lambda s, d: metrics.peak_hour_mape(_accuracy(s, d), [], "actual_mwh", "eia_forecast_mwh"))

_PARTS = ["pred_seasonal_naive", "pred_weekly_naive"]
register(
    "ensemble_mean",
    f"""SELECT period_utc, ba_code, {r('''(coalesce(pred_seasonal_naive, 0) + coalesce(pred_weekly_naive, 0))
            / nullif((pred_seasonal_naive IS NOT NULL)::INT + (pred_weekly_naive IS NOT NULL)::INT, 0)''', 4)} AS pred_ensemble
        FROM feed_baselines""",
)(
    lambda s, d: feeder_baselines(s, d).selectExpr(
        "period_utc", "ba_code", f"{half_up(row_mean(_PARTS), 4)} as pred_ensemble"
    )
)
register(
    "sorted_bands",
    """SELECT period_utc, ba_code, list_sort([net_generation_mwh, demand_mwh, demand_forecast_mwh], 'ASC', 'NULLS LAST')[1] AS p10,
              list_sort([net_generation_mwh, demand_mwh, demand_forecast_mwh], 'ASC', 'NULLS LAST')[2] AS p50,
              list_sort([net_generation_mwh, demand_mwh, demand_forecast_mwh], 'ASC', 'NULLS LAST')[3] AS p90 FROM feed_wide""",
)(
    lambda s, d: _wide(s, d)
    .selectExpr("period_utc", "ba_code", "net_generation_mwh as p10", "demand_mwh as p50", "demand_forecast_mwh as p90")
    .withColumns(exprs(sorted_row(["p10", "p50", "p90"])))
)
def _wide(spark, sf_dir):
    from wattloom.catalogue.base import feeder_wide

    return feeder_wide(spark, sf_dir)


def _long(spark, sf_dir):
    from wattloom.sources import adapters

    return adapters.feeder_measures(spark, sf_dir)


@register("holt_winters")
def _holt_winters(spark, sf_dir):
    """Fitted per series: property-tested, no SQL equivalent."""
    from wattloom.operators.smoothing import holt_winters

    return holt_winters(written(_model_frame(spark, sf_dir).select("ba_code", "period_utc", "demand_mwh"), "frame"), 24)
