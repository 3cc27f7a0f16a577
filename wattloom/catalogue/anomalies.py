"""Anomaly detectors and their composition."""

from __future__ import annotations

from wattloom.catalogue.base import feeder_fact, feeder_gold, r, register, view
from wattloom.functions.scalars import half_up, rounded
from wattloom.plans import anomaly
from wattloom.session import written

view(
    "hours_scored",
    "SELECT * FROM feed_fact WHERE demand_mwh IS NOT NULL AND NOT coalesce(flag_implausible_magnitude, false)",
)
view(
    "cell_stats",
    """
    SELECT ba_code, hour_local, month, any_value(med) AS cell_median, median(abs(demand_mwh - med)) AS cell_mad
    FROM (SELECT *, median(demand_mwh) OVER (PARTITION BY ba_code, hour_local, month) AS med FROM hours_scored)
    GROUP BY ba_code, hour_local, month
    """,
)
view(
    "hours_z",
    """
    SELECT h.*, coalesce(abs((demand_mwh - cell_median) / nullif(cell_mad / 0.6745::DOUBLE, 0)), 0) AS robust_z,
           sign(demand_mwh - cell_median) AS residual_sign,
           lag(demand_mwh) OVER (PARTITION BY h.ba_code ORDER BY period_utc) AS prev
    FROM hours_scored h JOIN cell_stats USING (ba_code, hour_local, month)
    """,
)
view(
    "hours_ramp",
    """
    SELECT *, demand_mwh - prev AS ramp_mwh,
           CASE WHEN prev = 0 THEN CASE WHEN demand_mwh > 0 THEN 'Infinity'::DOUBLE WHEN demand_mwh < 0 THEN '-Infinity'::DOUBLE END
                ELSE (demand_mwh - prev) / prev * 100 END AS ramp_pct
    FROM hours_z
    """,
)


def _fact(spark, sf_dir):
    return feeder_fact(spark, sf_dir, *anomaly.SCORE_INPUTS)


register("scored_hours", f"SELECT {', '.join(anomaly.SCORE_INPUTS)} FROM hours_scored")(
    lambda s, d: anomaly.scored_hours(feeder_gold(s, d)["fact_demand_hourly"])
)
register(
    "seasonal_cells",
    f"SELECT ba_code, hour_local, month, {r('cell_median', 4)} AS cell_median, {r('cell_mad', 4)} AS cell_mad FROM cell_stats",
)(lambda s, d: rounded(anomaly.seasonal_cells(anomaly.scored_hours(feeder_gold(s, d)["fact_demand_hourly"])), 4, "cell_median", "cell_mad"))
register(
    "robust_seasonal_z",
    f"SELECT period_utc, ba_code, {r('robust_z', 4)} AS robust_z, residual_sign FROM hours_z",
)(
    lambda s, d: rounded(
        anomaly.robust_seasonal_z(anomaly.scored_hours(_fact(s, d))).select("period_utc", "ba_code", "robust_z", "residual_sign"),
        4, "robust_z",
    )
)


def _inputs(spark, sf_dir):
    return anomaly.isolation_inputs(anomaly.with_ramps(anomaly.scored_hours(_fact(spark, sf_dir))))


_X = [f"x_{c}" for c in anomaly.ISO_FEATURES]
_FINITE = "CASE WHEN isfinite({c}) THEN {c} END"
register(
    "isolation_inputs",
    f"""SELECT period_utc, ba_code, demand_mwh AS x_demand_mwh, {r('ramp_mwh', 4)} AS x_ramp_mwh,
               {r(_FINITE.format(c='ramp_pct'), 4)} AS x_ramp_pct, temperature_2m AS x_temperature_2m,
               {r('CASE WHEN temperature_2m IS NOT NULL THEN demand_mwh / greatest(abs(temperature_2m - 18), 0.5::DOUBLE) END', 4)}
               AS x_demand_per_degree FROM hours_ramp""",
)(lambda s, d: rounded(_inputs(s, d).select("period_utc", "ba_code", *_X), 4, "x_ramp_mwh", "x_ramp_pct", "x_demand_per_degree"))

_FULL = ", ".join(f"avg(demand_mwh) FILTER (WHERE hour_local = {h})" for h in range(24))
view(
    "day_shapes",
    f"""
    SELECT ba_code, date_local, level, list_transform(vals, lambda v: v / level) AS profile
    FROM (SELECT ba_code, date_local, vals, list_median(vals) AS level
          FROM (SELECT ba_code, date_local, [{_FULL}] AS vals FROM hours_scored GROUP BY ba_code, date_local)
          WHERE len(list_filter(vals, lambda v: v IS NOT NULL)) = 24)
    WHERE level > 1
    """,
)
register(
    "daily_profiles",
    f"""SELECT ba_code, date_local, {r('level', 4)} AS level, {', '.join(f"{r(f'profile[{h + 1}]', 6)} AS h{h}" for h in range(24))}
        FROM day_shapes WHERE len(list_filter(profile, lambda v: v > 0.05 AND v < 20)) = 24""",
)(
    lambda s, d: anomaly.daily_profiles(anomaly.scored_hours(_fact(s, d))).selectExpr(
        "ba_code", "date_local", f"{half_up('level', 4)} as level", *[f"{half_up(f'profile[{h}]', 6)} as h{h}" for h in range(24)]
    )
)

_RULE = "(coalesce(flag_frozen_reading, false) OR coalesce(flag_nonpositive_demand, false) OR coalesce(flag_extreme_ramp, false))"
view(
    "rule_scores",
    f"""
    SELECT period_utc, ba_code, date_local, hour_local, demand_mwh, temperature_2m, {r('robust_z', 4)} AS robust_z,
           CAST(NULL AS DOUBLE) AS iso_score, CAST(NULL AS DOUBLE) AS ae_reconstruction_error,
           CASE WHEN isfinite(ramp_pct) THEN {r(_FINITE.format(c='ramp_pct'), 4)} END AS ramp_pct, z_flag, false AS iso_flag,
           false AS ae_anomalous_day, rule_flag, votes AS detector_votes, votes >= 1 AS is_anomaly,
           CASE votes WHEN 0 THEN 'none' WHEN 1 THEN 'low' WHEN 2 THEN 'medium' ELSE 'high' END AS severity,
           CASE WHEN votes = 0 THEN 'normal' WHEN coalesce(flag_frozen_reading, false) THEN 'frozen_telemetry'
                WHEN coalesce(flag_nonpositive_demand, false) THEN 'invalid_reading'
                WHEN abs(ramp_pct) > 40 THEN 'extreme_ramp'
                WHEN robust_z > 4 THEN CASE WHEN residual_sign > 0 THEN 'demand_spike' ELSE 'demand_drop' END
                ELSE 'multivariate_outlier' END AS anomaly_type
    FROM (SELECT *, robust_z > 4.0 AS z_flag, {_RULE} AS rule_flag, (robust_z > 4.0)::INT + {_RULE}::INT AS votes FROM hours_ramp)
    """,
)


def rule_scores(spark, sf_dir):
    scores = anomaly.rule_and_season_scores(_fact(spark, sf_dir))
    return rounded(scores.withColumn("ramp_pct", _finite("ramp_pct")), 4, "robust_z", "ramp_pct")


def _finite(column):
    from pyspark.sql import functions as F

    from wattloom.functions.scalars import only_finite

    return F.expr(only_finite(column))


register("rule_scores", "SELECT * FROM rule_scores")(rule_scores)
register(
    "anomaly_summary",
    f"""SELECT count(*) AS hours_scored, count(*) FILTER (WHERE is_anomaly) AS anomalies_found,
               {r('100.0::DOUBLE * count(*) FILTER (WHERE is_anomaly) / count(*)', 3)} AS anomaly_rate_pct FROM rule_scores""",
)(lambda s, d: anomaly.summary(rule_scores(s, d)))
register(
    "anomaly_breakdown",
    """SELECT 'severity' AS of, severity AS name, count(*) AS hours FROM rule_scores GROUP BY ALL
       UNION ALL SELECT 'type', anomaly_type, count(*) FROM rule_scores WHERE is_anomaly GROUP BY ALL""",
)(lambda s, d: anomaly.breakdown(rule_scores(s, d)))

# All four voters, two of them by a rule in place of the fitted detectors.
_GIVEN_ISO, _GIVEN_DAY = "hour_local = 17 AND demand_mwh > 3500", "day(date_local) % 7 = 3"
view(
    "voted",
    f"""
    SELECT *, {_RULE} AS by_rule, coalesce(robust_z > 4, false) AS by_season, coalesce({_GIVEN_ISO}, false) AS by_forest, {_GIVEN_DAY} AS by_day
    FROM hours_ramp
    """,
)


@register(
    "four_voter_scores",
    f"""
    SELECT period_utc, ba_code, z_flag, iso_flag, ae_anomalous_day, rule_flag, len(list_filter([by_rule, by_season, by_forest, by_day], lambda v: v)) AS detector_votes,
           detector_votes > 0 AS is_anomaly, ['none', 'low', 'medium', 'high', 'high'][detector_votes + 1] AS severity,
           CASE WHEN detector_votes = 0 THEN 'normal' WHEN flag_frozen_reading THEN 'frozen_telemetry' WHEN flag_nonpositive_demand THEN 'invalid_reading'
                WHEN abs(ramp_pct) > 40 THEN 'extreme_ramp' WHEN by_season AND residual_sign > 0 THEN 'demand_spike' WHEN by_season THEN 'demand_drop'
                WHEN by_day THEN 'unusual_daily_shape' ELSE 'multivariate_outlier' END AS anomaly_type
    FROM (SELECT *, robust_z > 4 AS z_flag, by_forest AS iso_flag, by_day AS ae_anomalous_day, by_rule AS rule_flag FROM voted)
    """,
)
def _four_voters(spark, sf_dir):
    rows = anomaly.with_ramps(anomaly.robust_seasonal_z(anomaly.scored_hours(_fact(spark, sf_dir))))
    given = rows.selectExpr(
        "*", f"coalesce({_GIVEN_ISO}, false) as iso_flag", f"{_GIVEN_DAY} as ae_anomalous_day", "0D as iso_score", "0D as ae_reconstruction_error"
    )
    return anomaly.combine(given).select(
        "period_utc", "ba_code", "z_flag", "iso_flag", "ae_anomalous_day", "rule_flag", "detector_votes", "is_anomaly", "severity", "anomaly_type"
    )


register(
    "anomaly_counts",
    "SELECT anomaly_type, severity, count(*) AS n FROM rule_scores WHERE is_anomaly GROUP BY 1, 2",
)(lambda s, d: anomaly.counts_by(rule_scores(s, d), "anomaly_type", "severity"))
register("anomalies_by_key", "SELECT ba_code, count(*) AS n FROM rule_scores WHERE is_anomaly GROUP BY 1")(
    lambda s, d: anomaly.counts_by(rule_scores(s, d), "ba_code")
)

# Fitted detectors: no SQL equivalent, property-tested instead.
register("isolation_forest")(
    lambda s, d: anomaly.isolation_scores(written(anomaly.with_ramps(anomaly.scored_hours(_fact(s, d))), "hours")).select(
        "period_utc", "ba_code", "iso_score", "iso_flag"
    )
)
register("day_shape_errors")(lambda s, d: anomaly.shape_scores(anomaly.scored_hours(_fact(s, d))))
register("anomaly_scores")(lambda s, d: anomaly.detect(_fact(s, d)))
