"""Feature engineering, splits, scalers and training windows."""

from __future__ import annotations

from wattloom.catalogue.base import event_gold, feeder_gold, r, register, view
from wattloom.functions.scalars import hour_number, rounded
from wattloom.operators import windows
from wattloom.operators.chunking import with_ordinal, with_previous
from wattloom.operators.series import interpolate_gaps
from wattloom.plans import baselines, features
from wattloom.session import written


def feeder_frame(spark, sf_dir):
    """Read once by the caller."""
    return features.modelling_frame(feeder_gold(spark, sf_dir)["fact_demand_hourly"])


def written_frame(spark, sf_dir, *columns):
    """Read several times by the caller."""
    frame = feeder_frame(spark, sf_dir)
    return written(frame.select(*columns) if columns else frame, "modelling_frame")


def feeder_features(spark, sf_dir):
    return features.build_features(written_frame(spark, sf_dir))


view(
    "feed_model",
    """
    SELECT period_utc, ba_code, date_local, hour_local, demand_clean_mwh AS demand_mwh, demand_forecast_mwh,
           temperature_2m, apparent_temperature, relative_humidity_2m, dew_point_2m, cloud_cover, wind_speed_10m,
           shortwave_radiation, day_of_week, is_weekend, is_holiday, is_business_day, is_day_before_holiday,
           is_day_after_holiday, month, year
    FROM feed_fact
    """,
)

_WEATHER = features.WEATHER_INPUTS


def _filled(column: str, source_value: str) -> str:
    """Linear filling with a limit of six rows from either side, positions in ``rn``."""
    b, a = f"b_{column}", f"a_{column}"
    return f"""CASE WHEN {source_value} IS NOT NULL THEN {source_value}
        WHEN {b} IS NOT NULL AND {a} IS NOT NULL AND least(rn - {b}.p, {a}.p - rn) <= 6
            THEN {b}.v + ({a}.v - {b}.v) * (rn - {b}.p) / ({a}.p - {b}.p)
        WHEN {a} IS NULL AND rn - {b}.p <= 6 THEN {b}.v
        WHEN {b} IS NULL AND {a}.p - rn <= 6 THEN {a}.v END"""


def _neighbours(columns) -> str:
    parts = []
    for c in columns:
        pair = f"CASE WHEN {c} IS NOT NULL THEN {{'p': rn, 'v': {c}}} END"
        parts.append(f"last_value({pair} IGNORE NULLS) OVER (PARTITION BY ba_code ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS b_{c}")
        parts.append(f"first_value({pair} IGNORE NULLS) OVER (PARTITION BY ba_code ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS a_{c}")
    return ", ".join(parts)


_W = "OVER (PARTITION BY ba_code ORDER BY period_utc"
view(
    "feed_lagged",
    f"""
    SELECT *, row_number() {_W}) AS rn,
           {', '.join(f'lag(demand_mwh, {h}) {_W}) AS demand_lag_{h}h' for h in features.LAGS)},
           {', '.join(
               f'''CASE WHEN count(demand_mwh) {_W} ROWS BETWEEN {23 + w} PRECEDING AND 24 PRECEDING) >= {w // 4}
                   THEN {fn}(demand_mwh) {_W} ROWS BETWEEN {23 + w} PRECEDING AND 24 PRECEDING) END AS demand_roll_{k}_{w}h'''
               for w in features.ROLLING for k, fn in (('mean', 'avg'), ('std', 'stddev_samp')))},
           lag(temperature_2m, 24) {_W}) AS temp_lag_24h,
           CASE WHEN count(temperature_2m) {_W} ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) >= 6
                THEN avg(temperature_2m) {_W} ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) END AS temp_roll_mean_24h,
           CASE WHEN temperature_2m IS NOT NULL THEN greatest(18.0::DOUBLE - temperature_2m, 0) END AS heating_degrees,
           CASE WHEN temperature_2m IS NOT NULL THEN greatest(temperature_2m - 18.0::DOUBLE, 0) END AS cooling_degrees,
           CAST(coalesce(is_business_day, false) AS INTEGER) AS business
    FROM feed_model
    """,
)
view("feed_near", f"SELECT *, {_neighbours(_WEATHER)} FROM feed_lagged")
view("model_median", "SELECT ba_code, median(demand_mwh) AS med FROM feed_model GROUP BY ba_code")
_CIRCLES = ", ".join(
    f"{fn}(2 * pi() * {value} / {period}::DOUBLE) AS {name}_{fn}"
    for name, value, period in (("hour", "hour_local", 24), ("dow", "day_of_week", 7), ("doy", "dayofyear(date_local)", 365.25))
    for fn in ("sin", "cos")
)
view(
    "feed_features",
    f"""
    SELECT f.period_utc, f.ba_code, f.date_local, f.hour_local, f.demand_mwh, f.demand_forecast_mwh, f.day_of_week, f.month,
           f.year, {_CIRCLES},
           {', '.join(f'CAST(coalesce({c}, false) AS INTEGER) AS {c}' for c in features.FLAGS)},
           {', '.join(features.LAG_COLUMNS)},
           {', '.join(f'demand_roll_{k}_{w}h' for k in ('mean', 'std') for w in features.ROLLING)},
           demand_lag_168h - demand_lag_336h AS demand_same_hour_last_week_delta,
           {', '.join(_filled(c, c) + f' AS {c}' for c in _WEATHER)},
           heating_degrees, cooling_degrees, temperature_2m * temperature_2m AS temp_squared, temp_lag_24h,
           temperature_2m - temp_lag_24h AS temp_change_24h, temp_roll_mean_24h,
           cooling_degrees * business AS cooling_x_business, heating_degrees * business AS heating_x_business,
           cooling_degrees * hour_local AS cooling_x_hour
    FROM feed_near f JOIN model_median m ON m.ba_code = f.ba_code
    WHERE demand_mwh IS NOT NULL AND NOT (demand_mwh < med * 0.2::DOUBLE OR demand_mwh > med * 5.0::DOUBLE)
      AND {' AND '.join(f'{c} IS NOT NULL' for c in features.LAG_COLUMNS)}
    """,
)

register("modelling_frame", "SELECT * FROM feed_model")(feeder_frame)

_REAL = [c for c in features.FEATURES if c not in features.FLAGS]
register("build_features", f"SELECT * REPLACE ({', '.join(f'{r(c, 4)} AS {c}' for c in _REAL)}) FROM feed_features")(
    lambda s, d: rounded(feeder_features(s, d), 4, *_REAL)
)

register(
    "implausible_demand",
    """SELECT period_utc, ba_code, demand_mwh,
              coalesce(demand_mwh < med * 0.2::DOUBLE OR demand_mwh > med * 5.0::DOUBLE, false) AS flag_implausible
       FROM feed_wide LEFT JOIN (SELECT ba_code, median(demand_mwh) AS med FROM feed_wide GROUP BY 1) USING (ba_code)""",
)(lambda s, d: features.flag_implausible(written(_wide(s, d).select("period_utc", "ba_code", "demand_mwh"), "wide")))


def _wide(spark, sf_dir):
    from wattloom.catalogue.base import feeder_wide

    return feeder_wide(spark, sf_dir)


_EVENT_MEASURES = ["demand_mwh", "demand_forecast_mwh", "net_generation_mwh"]
view(
    "event_gaps",
    f"""SELECT *, {_neighbours(_EVENT_MEASURES)} FROM (SELECT *, row_number() {_W}) AS rn FROM event_silver)""",
)


@register(
    "interpolate_gaps",
    f"""SELECT ba_code, period_utc, {', '.join(r(_filled(c, c), 6) + f' AS {c}' for c in _EVENT_MEASURES)} FROM event_gaps""",
)
def _gaps(spark, sf_dir):
    silver = event_gold(spark, sf_dir)["silver_grid_hourly"].select("ba_code", "period_utc", *_EVENT_MEASURES)
    silver = written(silver, "silver_grid_hourly")
    return rounded(interpolate_gaps(silver, ["ba_code"], hour_number(), _EVENT_MEASURES), 6, *_EVENT_MEASURES)


def _counts(frame):
    from pyspark.sql import functions as F

    return frame.groupBy("split", "ba_code").agg(
        F.count(F.lit(1)).alias("n"), F.min("period_utc").alias("first"), F.max("period_utc").alias("last")
    )


def _split_sql(test, valid):
    return f"""
    SELECT split, ba_code, count(*) AS n, min(period_utc) AS first, max(period_utc) AS last FROM (
        SELECT *, CASE WHEN period_utc {valid} hi - INTERVAL 35 DAY THEN 'train'
                       WHEN period_utc {test} hi - INTERVAL 20 DAY THEN 'valid' ELSE 'test' END AS split
        FROM feed_model, (SELECT max(period_utc) AS hi FROM feed_model))
    GROUP BY split, ba_code"""


register("chronological_split", _split_sql("<=", "<="))(
    lambda s, d: _counts(features.chronological_split(written_frame(s, d, "ba_code", "period_utc"), test_days=20, valid_days=15))
)
register("training_split", _split_sql("<", "<"))(
    lambda s, d: _counts(features.training_split(written_frame(s, d, "ba_code", "period_utc"), test_days=20, valid_days=15))
)

register(
    "row_ordinals",
    f"SELECT ba_code, period_utc, row_number() {_W}) - 1 AS ordinal FROM event_wide",
)(lambda s, d: with_ordinal(_events(s, d).select("ba_code", "period_utc"), ["ba_code"], "period_utc", hours=48))
register(
    "previous_reading",
    f"SELECT ba_code, period_utc, demand_mwh, lag(demand_mwh) {_W}) AS previous_mwh FROM event_wide",
)(
    lambda s, d: with_previous(
        _events(s, d).select("ba_code", "period_utc", "demand_mwh"), ["ba_code"], "period_utc", "demand_mwh", "previous_mwh", hours=48
    )
)
register(
    "spine_breaks",
    f"""SELECT * FROM (SELECT ba_code, period_utc,
               (epoch(period_utc) - epoch(lag(period_utc) {_W}))) / 3600 AS step_hours FROM event_wide) WHERE step_hours <> 1""",
)(lambda s, d: baselines.spine_breaks(_events(s, d)))


def _events(spark, sf_dir):
    from wattloom.operators.series import pivot_latest
    from wattloom.sources import adapters

    return pivot_latest(adapters.event_measures(spark, sf_dir), "seq")


# ------------------------------------------------------------------ scalers and windows

view(
    "model_stats",
    """
    SELECT ba_code, centre, CASE WHEN iqr > 0 THEN iqr ELSE greatest(centre * 0.1::DOUBLE, 1) END AS spread
    FROM (SELECT ba_code, median(demand_mwh) AS centre,
                 (quantile_cont(demand_mwh, 0.75) - quantile_cont(demand_mwh, 0.25)) / 1.349::DOUBLE AS iqr
          FROM feed_model WHERE demand_mwh IS NOT NULL GROUP BY ba_code)
    """,
)
register("target_stats", f"SELECT ba_code, {r('centre', 6)} AS centre, {r('spread', 6)} AS spread FROM model_stats")(
    lambda s, d: rounded(windows.target_stats(feeder_frame(s, d)), 6, "centre", "spread")
)


@register(
    "scaled_target",
    f"""SELECT ba_code, period_utc, demand_mwh, {r('(demand_mwh - centre) / spread', 6)} AS target_z
        FROM feed_model JOIN model_stats USING (ba_code)""",
)
def _scaled(spark, sf_dir):
    frame = written_frame(spark, sf_dir, "ba_code", "period_utc", "demand_mwh")
    z = windows.scale_target(frame, windows.target_stats(frame), windows.global_stats(frame))
    return rounded(z, 6, "target_z")


@register(
    "unscaled_target",
    f"""SELECT ba_code, period_utc, demand_mwh, {r('centre + spread * (hour(period_utc) % 5 - 2) / 4', 4)} AS target_z
        FROM feed_model JOIN model_stats USING (ba_code)""",
)
def _unscaled(spark, sf_dir):
    """Scaled predictions that depend on the hour, back in physical units."""
    frame = written_frame(spark, sf_dir, "ba_code", "period_utc", "demand_mwh")
    predicted = frame.selectExpr("*", "cast((hour(period_utc) % 5 - 2) / 4D as double) as target_z")
    back = windows.unscale(predicted, windows.target_stats(frame), windows.global_stats(frame), ["target_z"])
    return rounded(back, 4, "target_z")


@register(
    "global_target_stats",
    f"""SELECT {r('quantile_cont(demand_mwh, 0.5)', 6)} AS centre,
               {r('(quantile_cont(demand_mwh, 0.75) - quantile_cont(demand_mwh, 0.25)) / 1.349::DOUBLE', 6)} AS spread FROM feed_model""",
)
def _global(spark, sf_dir):
    return rounded(windows.global_stats(feeder_frame(spark, sf_dir)), 6, "centre", "spread")


_CHANNELS = ["demand_mwh", "temperature_2m", "cloud_cover", "wind_speed_10m"]


@register(
    "standardised_channels",
    "SELECT ba_code, period_utc, "
    + ", ".join(
        r(
            f"coalesce(({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () < 1e-6 THEN 1 ELSE stddev_pop({c}) OVER () END, 0)",
            6,
        )
        + f" AS {c}"
        for c in _CHANNELS
    )
    + " FROM feed_model",
)
def _standardised(spark, sf_dir):
    frame = written_frame(spark, sf_dir, "ba_code", "period_utc", *_CHANNELS)
    return rounded(windows.standardise(frame, windows.channel_stats(frame, _CHANNELS), _CHANNELS), 6, *_CHANNELS)


_VALID, _TEST = "timestamp'2023-01-20'", "timestamp'2023-02-01'"
view(
    "window_rows",
    f"""
    SELECT *, CASE WHEN period_utc < TIMESTAMP '2023-01-20' THEN 'train'
                   WHEN period_utc < TIMESTAMP '2023-02-01' THEN 'valid' ELSE 'test' END AS split,
           row_number() {_W}) - 1 AS ordinal, count(*) OVER (PARTITION BY ba_code) AS total
    FROM feed_features
    """,
)
_PAST = ["demand_mwh", "cloud_cover", "shortwave_radiation"]
_FUTURE = ["cloud_cover", "shortwave_radiation"]


@register(
    "sliding_windows",
    f"""
    SELECT ba_code, split, first - 168 AS start, min(period_utc) FILTER (WHERE ordinal = first) AS horizon_start,
           count(*) FILTER (WHERE ordinal < first) AS n_past, count(*) FILTER (WHERE ordinal >= first) AS n_future,
           {r('sum(CASE WHEN ordinal < first THEN cloud_cover * (ordinal - first + 168) END)', 3)} AS past_sum,
           {r('sum(CASE WHEN ordinal >= first THEN shortwave_radiation * (ordinal - first) END)', 3)} AS future_sum,
           {r('sum(CASE WHEN ordinal >= first THEN CAST(demand_mwh AS FLOAT) END)', 1)} AS target_sum
    FROM (
        SELECT w.ba_code, w.split, w.ordinal AS first, v.ordinal, v.period_utc, v.cloud_cover, v.shortwave_radiation, v.demand_mwh
        FROM (SELECT *, min(ordinal) FILTER (WHERE ordinal >= 168) OVER (PARTITION BY ba_code, split) AS f FROM window_rows) w
        JOIN window_rows v ON v.ba_code = w.ba_code AND v.ordinal BETWEEN w.ordinal - 168 AND w.ordinal + 23
        WHERE w.ordinal >= 168 AND w.ordinal + 24 <= w.total
          AND (w.ordinal - w.f) % CASE WHEN w.split = 'test' THEN 6 ELSE 12 END = 0
          AND (v.ordinal >= w.ordinal OR (v.ordinal - w.ordinal + 168) % 3 = 0))
    GROUP BY ba_code, split, first
    """,
)
def _windows(spark, sf_dir):
    """Shape, position-weighted content and target sum of every window."""
    found = windows.sliding_windows(
        written(feeder_features(spark, sf_dir), "features"), _VALID, _TEST, past=_PAST, future=_FUTURE, target="demand_mwh"
    )
    total = "aggregate({a}, 0D, (acc, x) -> acc + x)"
    past = total.format(a="transform(past, (v, i) -> cast(v[1] as double) * i * 3)")
    ahead = total.format(a="transform(future, (v, i) -> cast(v[1] as double) * i)")
    target = total.format(a="transform(target, v -> cast(v as double))")
    return rounded(
        found.selectExpr(
            "ba_code", "split", "start", "horizon_start", "size(past) as n_past", "size(future) as n_future",
            f"{past} as past_sum", f"{ahead} as future_sum", f"{target} as target_sum",
        ),
        3, "past_sum", "future_sum",
    ).selectExpr("* except (target_sum)", "cast(round(cast(target_sum as decimal(38,6)), 1) as double) as target_sum")


@register(
    "reconciled_windows",
    f"""
    SELECT ba_code, make_timestamp(ordinal * 3600 * 1000000) AS period_utc, {r('avg(said)', 4)} AS prediction, count(*) AS n_windows
    FROM (
        SELECT v.ba_code, v.ordinal, CAST(v.demand_mwh AS FLOAT)::DOUBLE + (w.ordinal - 168) % 7 AS said
        FROM (SELECT *, min(ordinal) FILTER (WHERE ordinal >= 168) OVER (PARTITION BY ba_code, split) AS f FROM window_rows) w
        JOIN window_rows v ON v.ba_code = w.ba_code AND v.ordinal BETWEEN w.ordinal AND w.ordinal + 23
        WHERE w.ordinal >= 168 AND w.ordinal + 24 <= w.total AND (w.ordinal - w.f) % CASE WHEN w.split = 'test' THEN 6 ELSE 12 END = 0)
    GROUP BY ba_code, ordinal
    """,
)
def _reconciled(spark, sf_dir):
    """Every window forecasts its hours (here: their demand and a shift of its own); overlapping forecasts are reconciled by position."""
    from wattloom.operators import metrics

    found = windows.sliding_windows(
        written(feeder_features(spark, sf_dir), "features"), _VALID, _TEST, past=_PAST, future=_FUTURE, target="demand_mwh"
    )
    said = found.selectExpr("ba_code", "start", "posexplode(target) as (step, value)").selectExpr(
        "ba_code", "timestamp_seconds(3600 * (start + 168 + step)) as period_utc", "cast(value as double) + start % 7 as prediction"
    )
    return rounded(metrics.reconcile(said), 4, "prediction")
