"""Served queries, guarded SQL, diagnostics and fitted models."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattloom.catalogue.anomalies import rule_scores
from wattloom.catalogue.base import feeder_fact, feeder_gold, r, register, view
from wattloom.catalogue.features import written_frame
from wattloom.catalogue.forecasting import feeder_baselines, feeder_board
from wattloom.catalogue.quality import _results
from wattloom.functions.scalars import rounded
from wattloom.operators import metrics, windows
from wattloom.plans import diagnostics, features, guard, inference, models, served
from wattloom.session import remembered, side_by_side, written
from wattloom.sources import adapters, catalog

KEY = "BA000000"


def _fact(spark, sf_dir):
    return feeder_gold(spark, sf_dir)["fact_demand_hourly"]


register(
    "recent_demand",
    f"""SELECT strftime(period_utc, '%Y-%m-%dT%H:%M:%SZ') AS period_utc, demand_mwh, demand_forecast_mwh, temperature_2m
        FROM (SELECT * FROM feed_fact WHERE ba_code = '{KEY}' ORDER BY period_utc DESC LIMIT 168)""",
)(lambda s, d: served.recent_demand(_fact(s, d), KEY))
register(
    "accuracy_by_key",
    f"""SELECT ba_code, {r('avg(abs_pct_error)', 3)} AS eia_mape_pct, {r('avg(error_mwh)', 1)} AS mean_bias_mwh, count(*) AS hours
        FROM feed_accuracy GROUP BY ba_code""",
)(lambda s, d: served.accuracy_by_key(feeder_gold(s, d)["fact_forecast_accuracy"]))
register(
    "recent_anomalies",
    f"""SELECT strftime(period_utc, '%Y-%m-%dT%H:%M:%SZ') AS period_utc, ba_code, demand_mwh, temperature_2m, anomaly_type, severity,
               detector_votes, {r('robust_z', 2)} AS robust_z
        FROM (SELECT * FROM rule_scores WHERE is_anomaly AND severity = 'medium' ORDER BY period_utc DESC, ba_code LIMIT 200)""",
)(lambda s, d: served.recent_anomalies(rule_scores(s, d), "medium"))
register(
    "serious_anomalies",
    f"""SELECT period_utc, ba_code, {r('demand_mwh')} AS demand_mw, {r('temperature_2m', 1)} AS temp_c, anomaly_type, severity,
               detector_votes, {r('robust_z', 2)} AS robust_z
        FROM (SELECT * FROM rule_scores WHERE is_anomaly AND severity IN ('high', 'medium') ORDER BY period_utc DESC, ba_code LIMIT 200)""",
)(lambda s, d: served.serious_anomalies(rule_scores(s, d)))
register(
    "quality_detail",
    """SELECT check_name, dimension, severity, failed_rows, total_rows, failure_rate_pct, threshold_pct, passed, description
       FROM feed_dq""",
)(lambda s, d: served.quality_detail(_results(s, d)))
register(
    "fleet_summary",
    f"""SELECT count(*) AS hours, count(DISTINCT ba_code) AS bas, {r('avg(demand_clean_mwh)')} AS avg_demand,
               max(demand_clean_mwh) AS peak FROM feed_fact WHERE demand_clean_mwh IS NOT NULL""",
)(lambda s, d: served.fleet_summary(_fact(s, d)))
register("coverage_span", "SELECT min(period_utc) AS lo, max(period_utc) AS hi, count(*) AS n FROM feed_fact")(
    lambda s, d: served.coverage_span(_fact(s, d))
)
view("recent_fact", "SELECT * FROM feed_fact WHERE period_utc >= (SELECT max(period_utc) FROM feed_fact) - INTERVAL 30 DAY")
view(
    "key_history",
    f"""SELECT period_utc, hour_local, demand_clean_mwh AS demand_mwh, demand_forecast_mwh, temperature_2m, is_weekend, is_holiday, season
        FROM recent_fact WHERE ba_code = '{KEY}'""",
)


def _history(spark, sf_dir):
    return served.history_window(feeder_fact(spark, sf_dir), KEY)


register("history_window", "SELECT * FROM key_history")(_history)
register(
    "binned_response",
    f"""SELECT round_even(temperature_2m / 2, 0) * 2 AS bin, median(demand_mwh) AS median, count(*) AS size FROM key_history
        WHERE temperature_2m IS NOT NULL AND demand_mwh IS NOT NULL GROUP BY 1 HAVING count(*) >= 5""",
)(lambda s, d: served.binned_response(_history(s, d)))
register(
    "load_shape", f"SELECT hour_local, is_weekend, {r('avg(demand_mwh)', 4)} AS demand_mwh FROM key_history GROUP BY 1, 2"
)(lambda s, d: served.load_shape(_history(s, d)))
register(
    "fleet_comparison",
    f"""SELECT ba_code, {r('avg(demand_clean_mwh)')} AS mean_demand_mw, {r('max(demand_clean_mwh)')} AS peak_demand_mw
        FROM recent_fact WHERE demand_clean_mwh IS NOT NULL GROUP BY ba_code""",
)(lambda s, d: served.fleet_comparison(feeder_fact(s, d)))
register(
    "peak_by_key",
    """SELECT ba_code, max(demand_mwh) AS peak_mwh FROM feed_fact WHERE season = 'Winter' GROUP BY ba_code
       ORDER BY peak_mwh DESC, ba_code LIMIT 10""",
)(lambda s, d: served.peak_by_key(_fact(s, d), "Winter"))
register(
    "demand_by_degree",
    f"""SELECT {r('temperature_2m')} AS temp_c, {r('avg(demand_mwh)')} AS avg_demand_mwh, count(*) AS hours FROM feed_fact
        WHERE ba_code = '{KEY}' AND temperature_2m IS NOT NULL GROUP BY 1 ORDER BY 1 LIMIT 100""",
)(lambda s, d: served.demand_by_degree(_fact(s, d), KEY))
register("average_by_key", f"SELECT ba_code, {r('avg(demand_mwh)', 2)} AS avg_demand_mwh FROM feed_fact GROUP BY 1")(
    lambda s, d: served.average_by_key(_fact(s, d))
)
register(
    "average_by_hour",
    f"SELECT hour_local, {r('avg(demand_mwh)', 2)} AS avg_demand_mwh FROM feed_fact WHERE ba_code = '{KEY}' AND season = 'Winter' GROUP BY 1",
)(lambda s, d: served.average_by_hour(_fact(s, d), KEY, "Winter"))
register(
    "highest_hours",
    "SELECT ba_code, period_utc, demand_mwh FROM feed_fact ORDER BY demand_mwh DESC NULLS LAST, ba_code, period_utc LIMIT 10",
)(lambda s, d: served.highest_hours(_fact(s, d)))
register(
    "weekday_against_weekend",
    f"""SELECT is_weekend, {r('avg(demand_mwh)', 2)} AS avg_demand_mwh, count(demand_mwh) AS hours FROM feed_fact
        WHERE ba_code = '{KEY}' GROUP BY 1""",
)(lambda s, d: served.weekday_against_weekend(_fact(s, d), KEY))
register(
    "medium_anomalies_by_key",
    "SELECT ba_code, count(*) AS anomalies FROM rule_scores WHERE is_anomaly AND severity = 'medium' GROUP BY 1",
)(lambda s, d: served.anomalies_of_severity(rule_scores(s, d), "medium"))


def _scores(spark, sf_dir):
    """Two runs in the score log: an older one of the same board, and the latest."""
    board = written(feeder_board(spark, sf_dir), "leaderboard")
    runs = [models.stamped_scores(board, "timestamp'2023-02-01'", f"timestamp'2023-0{m}-01'") for m in (2, 3)]
    return runs[0].unionByName(runs[1])


register(
    "latest_leaderboard",
    "SELECT *, TIMESTAMP '2023-03-01' AS trained_at_utc, TIMESTAMP '2023-02-01' AS test_window_start FROM board",
)(lambda s, d: served.latest_leaderboard(_scores(s, d)))
register("best_model", "SELECT model, mape_pct, skill_vs_eia_pct FROM board ORDER BY mape_pct LIMIT 1")(
    lambda s, d: served.best_model(_scores(s, d))
)

# ------------------------------------------------------------------ guarded SQL

QUESTION = """```sql
WITH summer AS (
    SELECT ba_code, demand_mwh, temperature_2m FROM fact_demand_hourly -- ; DELETE FROM dim_ba
    WHERE season = 'Winter')
SELECT ba_code, d.region, max(demand_mwh) AS peak_mwh, count(*) AS hours
FROM summer JOIN dim_ba d USING (ba_code)
WHERE temperature_2m > (SELECT min(temperature_2m) FROM fact_demand_hourly)
GROUP BY ba_code, d.region
```"""


@register(
    "guarded_sql",
    """SELECT ba_code, d.region, max(demand_mwh) AS peak_mwh, count(*) AS hours FROM feed_fact JOIN feed_dim d USING (ba_code)
       WHERE season = 'Winter' AND temperature_2m > (SELECT min(temperature_2m) FROM feed_fact) GROUP BY ALL""",
)
def _guarded(spark, sf_dir):
    gold = feeder_gold(spark, sf_dir)
    catalog.register({"fact_demand_hourly": written(gold["fact_demand_hourly"], "fact"), "dim_ba": gold["dim_ba"]})
    return guard.guarded_sql(spark, QUESTION)


# ------------------------------------------------------------------ diagnostics on the weekly baseline

_P = "pred_weekly_naive"
view(
    "weekly_ape",
    f"SELECT *, abs({_P} - demand_mwh) / nullif(demand_mwh, 0) * 100 AS ape FROM feed_baselines WHERE {_P} IS NOT NULL",
)


def _weekly(spark, sf_dir):
    return written(feeder_baselines(spark, sf_dir).where(f"{_P} is not null"), "predictions")


register(
    "error_by_key",
    f"""SELECT ba_code, count(*) AS hours, {r('avg(demand_mwh)', 2)} AS actual_mean_mw, {r(f'avg({_P})', 2)} AS pred_mean_mw,
               {r('avg(ape)', 2)} AS mape_pct, {r('max(ape)', 2)} AS worst_ape_pct FROM weekly_ape GROUP BY ba_code""",
)(lambda s, d: diagnostics.error_by_key(_weekly(s, d), _P))
register(
    "worst_rows",
    f"""SELECT period_utc, ba_code, demand_mwh, {_P}, {r('ape', 4)} AS ape FROM weekly_ape
        ORDER BY weekly_ape.ape DESC, ba_code, period_utc LIMIT 15""",
)(lambda s, d: rounded(diagnostics.worst_rows(_weekly(s, d), _P).select("period_utc", "ba_code", "demand_mwh", _P, "ape"), 4, "ape"))
register(
    "error_shares",
    f"""SELECT CAST(t AS INTEGER) AS threshold_pct, {r('avg(CASE WHEN ape > t THEN 1.0 ELSE 0.0 END) * 100', 4)} AS share_pct
        FROM weekly_ape CROSS JOIN (SELECT unnest([10, 25, 50, 100, 500]) AS t) GROUP BY t""",
)(lambda s, d: rounded(diagnostics.error_shares(_weekly(s, d), _P), 4, "share_pct"))
register(
    "error_concentration",
    f"""SELECT {r('sum(CASE WHEN rn <= floor(0.01::DOUBLE * total) THEN ape ELSE 0 END) / sum(ape) * 100', 4)} AS worst_share_pct,
               {r('avg(ape)', 4)} AS mape_pct, {r('median(ape)', 4)} AS median_ape_pct
        FROM (SELECT ape, row_number() OVER (ORDER BY ape DESC) AS rn, count(*) OVER () AS total FROM weekly_ape)""",
)(lambda s, d: rounded(diagnostics.error_concentration(_weekly(s, d), _P), 4, "worst_share_pct", "mape_pct", "median_ape_pct"))
register(
    "scaler_spread",
    f"SELECT {r('max(centre) / min(centre)', 6)} AS scale_ratio, count(*) AS keys FROM model_stats",
)(
    lambda s, d: rounded(
        diagnostics.scaler_spread(
            windows.target_stats(_fact(s, d).selectExpr("ba_code", "demand_clean_mwh as demand_mwh"))
        ),
        6, "scale_ratio",
    )
)
register(
    "keys_without_stats",
    "SELECT ba_code FROM feed_dim WHERE ba_code NOT IN (SELECT ba_code FROM feed_fact WHERE demand_clean_mwh > 4500 AND ba_code IS NOT NULL)",
)(
    lambda s, d: diagnostics.keys_without_stats(
        adapters.feeder_dimension(s, d),
        windows.target_stats(_fact(s, d).where("demand_clean_mwh > 4500").selectExpr("ba_code", "demand_clean_mwh as demand_mwh")),
    )
)
_TAIL = f"""SELECT *, (demand_mwh - lag(demand_mwh) OVER (ORDER BY period_utc))
                      / nullif(lag(demand_mwh) OVER (ORDER BY period_utc), 0) * 100 AS step_pct
            FROM (SELECT period_utc, demand_mwh, demand_clean_mwh, flag_isolated_spike, flag_extreme_ramp, flag_frozen_reading,
                         flag_implausible_magnitude FROM feed_fact WHERE ba_code = '{KEY}' ORDER BY period_utc DESC LIMIT 60)"""
view("key_tail", _TAIL)
register("series_tail", f"SELECT * REPLACE ({r('step_pct', 4)} AS step_pct) FROM key_tail")(
    lambda s, d: rounded(diagnostics.series_tail(_fact(s, d), KEY), 4, "step_pct")
)
register(
    "tail_summary",
    """SELECT count(*) AS hours, count(*) FILTER (WHERE demand_mwh IS NULL) AS demand_nulls,
              count(*) FILTER (WHERE demand_clean_mwh IS NULL) AS clean_nulls,
              count(*) FILTER (WHERE abs(step_pct) > 20) AS large_steps FROM key_tail""",
)(lambda s, d: diagnostics.tail_summary(diagnostics.series_tail(_fact(s, d), KEY)))

_WITH_WEATHER = "ascii(right(ba_code, 1)) % 2 = 0"


def _known_and_weather(spark, sf_dir):
    """The fact without each key's last day, and that day as the weather to come."""
    fact = feeder_fact(spark, sf_dir)
    newest = fact.groupBy("ba_code").agg(F.max("period_utc").alias("_newest"))
    dated = fact.join(newest, "ba_code").selectExpr("*", "unix_seconds(_newest) - unix_seconds(period_utc) < 86400 as _last_day").drop("_newest")
    return dated.where("not _last_day").drop("_last_day"), dated.where("_last_day").drop("_last_day")


view(
    "day_to_come",
    f"""SELECT *, period_utc + INTERVAL 24 HOUR > max(period_utc) OVER (PARTITION BY ba_code) AS to_come, {_WITH_WEATHER} AS forecast_there
        FROM feed_fact""",
)
view(
    "known_hours",
    "SELECT *, date_diff('hour', period_utc, max(period_utc) OVER (PARTITION BY ba_code)) AS age FROM day_to_come WHERE NOT to_come",
)


@register(
    "forecast_frame",
    """
    SELECT ba_code, period_utc, mode, target, if(target, NULL, demand_mwh) AS demand_mwh, if(target, demand_mwh, NULL) AS actual_mwh,
           temperature_2m, date_local, hour_local, is_weekend, is_holiday, month
    FROM (SELECT *, if(forecast_there, 'live', 'replay') AS mode, NOT forecast_there AND age < 24 AS target FROM known_hours WHERE age < 400)
    UNION ALL
    SELECT ba_code, period_utc, 'live', true, NULL, NULL, temperature_2m, date_local, hour_local, is_weekend, is_holiday, month
    FROM day_to_come WHERE to_come AND forecast_there
    """,
)
def _forecast_frame(spark, sf_dir):
    """What a forecast starts from: keys with weather to come go live, the others replay their last day."""
    known, weather = _known_and_weather(spark, sf_dir)
    frame = inference.assemble(known, adapters.feeder_dimension(spark, sf_dir), weather.where(_WITH_WEATHER))
    return frame.withColumnRenamed("_target", "target").select(
        "ba_code", "period_utc", "mode", "target", "demand_mwh", "actual_mwh", "temperature_2m", "date_local", "hour_local", "is_weekend", "is_holiday", "month"
    )


# ------------------------------------------------------------------ fitted models: property-tested, no SQL equivalent


_RUNS: dict = remembered()


def _train(spark, sf_dir):
    """Trained once an application and folder; all queries below use the same run."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RUNS:
        frame = written_frame(spark, sf_dir)
        dated = features.featured_rows(frame, "period_utc")
        _RUNS[key] = models.train_all(features.build_features(frame), test_days=20, valid_days=15, dated=dated)
    return _RUNS[key]


register("model_leaderboard")(lambda s, d: _train(s, d).leaderboard)
register("model_predictions")(lambda s, d: _train(s, d).predictions)


def _model(spark, sf_dir):
    return _train(spark, sf_dir).model


register("feature_importance")(lambda s, d: _model(s, d).importance(25))


def _forecast(spark, sf_dir, fact, weather=None):
    """The hours to forecast are written while the models train; the fact both read is written before."""
    dim = adapters.feeder_dimension(spark, sf_dir)
    model, rows = side_by_side(spark, lambda: _model(spark, sf_dir), lambda: inference.forecast_rows(fact, dim, weather))
    return inference.predicted(rows, model)


@register("replay_forecast")
def _replay(spark, sf_dir):
    return _forecast(spark, sf_dir, feeder_fact(spark, sf_dir))


@register("live_forecast")
def _live(spark, sf_dir):
    """The last day of the fact is cut off; its weather serves as the forecast of the next day."""
    return _forecast(spark, sf_dir, *_known_and_weather(spark, sf_dir))


@register("band_coverage")
def _coverage(spark, sf_dir):
    run = _train(spark, sf_dir)
    return metrics.coverage(run.predictions, ["ba_code"], "pred_gbm_p10", "pred_gbm_p90", "demand_mwh")
