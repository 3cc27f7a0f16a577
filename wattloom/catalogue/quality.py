"""Data-quality suite and table tests."""

from __future__ import annotations

from wattloom.catalogue.base import event_gold, feeder_gold, r, register, view
from wattloom.plans import marts, quality, table_tests
from wattloom.session import written

_DQ_COLUMNS = [
    "ba_code", "period_utc", "date_local", "demand_mwh", "demand_forecast_mwh", "demand_clean_mwh", "temperature_2m",
    "flag_missing_demand", "flag_frozen_reading", "flag_extreme_ramp",
]


def _tables(gold):
    """The fact is read by several checks, so it is written once first, as the built table would be."""
    fact = written(gold["fact_demand_hourly"].select(*_DQ_COLUMNS), "fact_demand_hourly")
    accuracy = fact.where("demand_clean_mwh is not null and demand_forecast_mwh is not null")
    return {
        "fact_demand_hourly": fact, "fact_forecast_accuracy": accuracy,
        "dim_ba": gold["dim_ba"], "dim_date": gold["dim_date"],
    }


def _results(spark, sf_dir, source=feeder_gold):
    return quality.run_suite(_tables(source(spark, sf_dir)), "timestamp'2023-03-01'", "timestamp'2023-03-01'")


# What is expected, in literal figures: check, dimension, severity, share that may fail, failures, cases.
_EXPECTED = (
    ("demand_not_null", "completeness", "warning", 0.02, "hours - readings", "hours", "Every hour of the spine carries a demand reading."),
    ("demand_positive", "validity", "critical", 0.001, "below", "readings", "Reported demand is above zero."),
    ("demand_magnitude_plausible", "validity", "critical", 0.0005, "far_off", "comparable", "Demand lies within 0.2 to 5 times the key''s own median."),
    ("demand_dispersion_sane", "validity", "critical", 0, "wide_keys", "trusted_keys", "No key''s trusted demand spreads wider than its mean."),
    ("cleaned_series_is_usable", "validity", "critical", 0.01, "readings - trusted", "readings", "Cleaning keeps nearly all reported readings."),
    ("no_duplicate_intervals", "uniqueness", "critical", 0, "hours - intervals", "intervals", "One row per key and hour."),
    ("no_missing_hours", "completeness", "warning", 0.02, "gaps", "hours", "No hour between first and last reading lacks demand."),
    ("no_frozen_readings", "validity", "warning", 0.005, "frozen", "hours", "Readings do not repeat for three hours or more."),
    ("no_extreme_ramps", "consistency", "warning", 0.01, "jumps", "hours", "Demand moves by at most 40 percent from hour to hour."),
    ("referential_integrity_ba", "consistency", "critical", 0, "hours - hours_of_known_keys", "hours", "Every fact row has its key in dim_ba."),
    ("referential_integrity_date", "consistency", "critical", 0, "hours - hours_of_known_days", "hours", "Every fact row has its date in dim_date."),
    ("weather_coverage", "completeness", "warning", 0.05, "hours - temperatures", "hours", "Nearly every hour has a temperature."),
    ("temperature_physically_plausible", "validity", "critical", 0, "impossible", "temperatures", "Temperatures lie between -60 and 60 degrees."),
    ("data_freshness", "timeliness", "warning", 0, "(newest < TIMESTAMP '2023-02-27')::INT", "1", "The latest reading is at most 48 hours old."),
    ("eia_benchmark_available", "accuracy", "critical", 0, "(published < 1000)::INT", "1", "The published forecast is there to be scored."),
    ("all_bas_present", "completeness", "critical", 0, "dim_keys - dim_keys_seen", "dim_keys", "Every key of dim_ba has fact rows."),
)


def _dq_sql(fact, accuracy, dim, dates):
    """One pass of conditional counts over the fact, one over its keys, and single counts of the other tables."""
    rows = ", ".join(f"('{name}', '{kind}', '{severity}', '{text}', {share}::DOUBLE, ({failed})::BIGINT, ({cases})::BIGINT)" for name, kind, severity, share, failed, cases, text in _EXPECTED)
    rate = "coalesce(failed_rows::DOUBLE / nullif(total_rows, 0), 0)"
    return f"""
    WITH scaled AS (
        SELECT *, median(if(demand_mwh > 0, demand_mwh, NULL)) OVER (PARTITION BY ba_code) AS middle FROM {fact}
    ), counted AS (
        SELECT count(*) AS hours, count(demand_mwh) AS readings, count(demand_clean_mwh) AS trusted, count(temperature_2m) AS temperatures,
               count_if(demand_mwh <= 0) AS below, count_if(flag_missing_demand) AS gaps, count_if(flag_frozen_reading) AS frozen,
               count_if(flag_extreme_ramp) AS jumps, coalesce(count_if(abs(temperature_2m) > 60), 0) AS impossible,
               count_if(demand_mwh IS NOT NULL AND middle IS NOT NULL) AS comparable,
               count_if(demand_mwh NOT BETWEEN 0.2::DOUBLE * middle AND 5::DOUBLE * middle) AS far_off,
               count(DISTINCT (ba_code, period_utc)) AS intervals, max(if(demand_mwh IS NULL, NULL, period_utc)) AS newest
        FROM scaled
    ), keys AS (
        SELECT count_if(spread > level) AS wide_keys, count(level) AS trusted_keys
        FROM (SELECT stddev_samp(demand_clean_mwh) AS spread, avg(demand_clean_mwh) AS level FROM {fact} GROUP BY ba_code)
    ), others AS (
        SELECT (SELECT count(*) FROM {accuracy}) AS published, (SELECT count(*) FROM {dim}) AS dim_keys,
               (SELECT count(*) FROM {dim} SEMI JOIN {fact} USING (ba_code)) AS dim_keys_seen,
               (SELECT count(*) FROM {fact} SEMI JOIN {dim} USING (ba_code)) AS hours_of_known_keys,
               (SELECT count(*) FROM {fact} WHERE date_local IN (SELECT date_day FROM {dates})) AS hours_of_known_days
    ), listed AS (
        SELECT l.* FROM counted, keys, others, LATERAL (VALUES {rows}) AS l(check_name, dimension, severity, description, threshold, failed_rows, total_rows)
    )
    SELECT TIMESTAMP '2023-03-01' AS run_at_utc, check_name, dimension, severity, description, failed_rows, total_rows,
           {r(f'100 * {rate}', 4)} AS failure_rate_pct, {r('100 * threshold', 4)} AS threshold_pct, {rate} <= threshold AS passed, NULL::VARCHAR AS error
    FROM listed
    """


view("feed_dq", _dq_sql("feed_fact", "feed_accuracy", "feed_dim", "feed_dates"))
view(
    "event_dim_all",
    "SELECT unnest(['PJM','MISO','ERCO','CISO','NYIS','ISNE','SWPP','BPAT','FPL','DUK','SOCO','TVA']) AS ba_code",
)
view("event_dq", _dq_sql("event_fact", "event_accuracy", "event_dim_all", "event_dates"))

register("dq_results", "SELECT * FROM feed_dq")(_results)
register("dq_results_events", "SELECT * FROM event_dq")(lambda s, d: _results(s, d, event_gold))
register(
    "dq_scorecard",
    f"""SELECT dimension, count(*) AS checks_run, count(*) FILTER (WHERE passed) AS checks_passed,
               {r('100.0::DOUBLE * count(*) FILTER (WHERE passed) / count(*)', 1)} AS pass_pct, max(run_at_utc) AS run_at_utc
        FROM feed_dq GROUP BY dimension""",
)(lambda s, d: quality.scorecard(_results(s, d)))

_W = "CASE severity WHEN 'critical' THEN 3.0::DOUBLE WHEN 'warning' THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END"
register(
    "dq_verdict",
    f"""SELECT {r(f'100 * sum(CASE WHEN passed THEN {_W} ELSE 0 END) / sum({_W})', 1)} AS score,
               count(*) FILTER (WHERE severity = 'critical' AND NOT passed) = 0 AS suite_passed,
               count(*) FILTER (WHERE passed) AS checks_passed, count(*) AS checks_run FROM event_dq""",
)(lambda s, d: quality.verdict(_results(s, d, event_gold)))


def _fail(name: str, condition: str, source: str) -> str:
    return f"SELECT '{name}' AS test, count(*) FILTER (WHERE {condition}) AS failed FROM {source}"


def _dup(table: str, columns: str, source: str) -> str:
    return (
        f"SELECT 'unique {table}.{columns.replace(', ', '+')}' AS test, count(*) FILTER (WHERE n > 1) AS failed "
        f"FROM (SELECT count(*) AS n FROM {source} GROUP BY {columns})"
    )


_TESTS = [
    _fail("not_null fact_demand_hourly.period_utc", "period_utc IS NULL", "feed_fact"),
    _fail("not_null fact_demand_hourly.ba_code", "ba_code IS NULL", "feed_fact"),
    _fail("not_null dim_ba.ba_code", "ba_code IS NULL", "feed_dim"),
    _dup("dim_ba", "ba_code", "feed_dim"),
    _fail("not_null dim_date.date_day", "date_day IS NULL", "feed_dates"),
    _dup("dim_date", "date_day", "feed_dates"),
    *[_fail(f"not_null stg_demand_hourly.{c}", f"{c} IS NULL", "stg_demand") for c in ("period_utc", "ba_code", "demand_mwh")],
    "SELECT 'relationship stg_demand_hourly.ba_code' AS test, count(*) AS failed FROM stg_demand "
    "WHERE ba_code NOT IN (SELECT ba_code FROM feed_dim)",
    _fail("accepted_range stg_demand_hourly.demand_mwh", "demand_mwh <= 0", "stg_demand"),
    _fail("accepted_values stg_demand_hourly.day_type", "day_type NOT IN ('Weekday','Weekend','Holiday')", "stg_demand"),
    _fail("accepted_range stg_forecast_accuracy.abs_pct_error", "abs_pct_error < 0 OR abs_pct_error > 500", "stg_accuracy"),
    *[_fail(f"not_null mart_daily_demand.{c}", f"{c} IS NULL", "mart_daily") for c in ("ba_code", "date_local")],
    _fail("accepted_range mart_daily_demand.load_factor", "load_factor < 0 OR load_factor > 1", "mart_daily"),
    _fail("accepted_range mart_daily_demand.peak_hour_local", "peak_hour_local < 0 OR peak_hour_local > 23", "mart_daily"),
    _dup("mart_daily_demand", "ba_code, date_local", "mart_daily"),
    "SELECT 'unique mart_load_profile.ba_code+season+day_type+hour_local' AS test, count(*) FILTER (WHERE n > 1) AS failed "
    "FROM (SELECT count(*) AS n FROM (SELECT DISTINCT ba_code, season, day_type, hour_local FROM stg_demand) "
    "GROUP BY ba_code, season, day_type, hour_local)",
    "SELECT 'not_null mart_forecast_scorecard.eia_mape_pct' AS test, count(*) FILTER (WHERE m IS NULL) AS failed FROM month_mape",
    "SELECT 'accepted_range mart_forecast_scorecard.eia_mape_pct' AS test, count(*) FILTER (WHERE m < 0 OR m > 100) AS failed FROM month_mape",
    "SELECT 'accepted_range mart_peak_events.pct_of_all_time_peak' AS test, count(*) FILTER (WHERE p > 100.01) AS failed "
    "FROM (SELECT 100.0 * peak_demand_mw / max(peak_demand_mw) OVER (PARTITION BY ba_code) AS p FROM mart_daily)",
]
view(
    "month_mape",
    "SELECT ba_code, date_trunc('month', date_local) AS mth, avg(abs_pct_error) AS m FROM stg_accuracy GROUP BY 1, 2",
)


@register("model_tests", " UNION ALL ".join(_TESTS))
def _model_tests(spark, sf_dir):
    gold = feeder_gold(spark, sf_dir)
    fact = written(gold["fact_demand_hourly"], "fact_demand_hourly")
    from wattloom.plans.warehouse import build_accuracy

    gold = {**gold, "fact_demand_hourly": fact, "fact_forecast_accuracy": build_accuracy(fact)}
    return table_tests.model_tests(gold, marts.build_marts(fact, gold["fact_forecast_accuracy"]))


@register(
    "asset_checks",
    """SELECT 'fact_table_populated' AS test,
              CASE WHEN count(*) > 0 AND count(DISTINCT ba_code) = (SELECT count(*) FROM event_dim_all) THEN 0 ELSE 1 END AS failed
       FROM event_fact
       UNION ALL
       SELECT 'benchmark_present', CASE WHEN count(*) > 1000 THEN 0 ELSE 1 END FROM event_accuracy""",
)
def _asset_checks(spark, sf_dir):
    from wattloom.registry import CODES

    gold = event_gold(spark, sf_dir)
    return table_tests.fact_populated(gold["fact_demand_hourly"], len(CODES)).unionByName(
        table_tests.benchmark_present(gold["fact_forecast_accuracy"])
    )
