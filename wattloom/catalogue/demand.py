"""Warehouse layers and marts."""

from __future__ import annotations

from wattloom.catalogue.base import event_gold, feeder_gold, feeder_wide, r, register, view
from wattloom.functions.scalars import rounded
from wattloom.operators.quantiles import grouped_quantiles
from wattloom.operators.series import hourly_spine, pivot_measures, series_bounds, upsert_measures
from wattloom.plans import marts
from wattloom.sources import adapters

register("feeder_dimension", "SELECT * FROM feed_dim")(lambda s, d: adapters.feeder_dimension(s, d))
register("silver_grid_hourly", "SELECT * FROM feed_silver")(lambda s, d: feeder_gold(s, d)["silver_grid_hourly"])
register("silver_without_weather", "SELECT * FROM event_silver")(lambda s, d: event_gold(s, d)["silver_grid_hourly"])
register("dim_date", "SELECT * FROM feed_dates")(lambda s, d: feeder_gold(s, d)["dim_date"])
register("fact_demand_hourly", "SELECT * FROM feed_fact")(lambda s, d: feeder_gold(s, d)["fact_demand_hourly"])
register("fact_demand_hourly_events", "SELECT * FROM event_fact")(lambda s, d: event_gold(s, d)["fact_demand_hourly"])


@register(
    "fact_forecast_accuracy",
    f"""SELECT period_utc, ba_code, date_local, hour_local, actual_mwh, eia_forecast_mwh, {r('error_mwh', 6)} AS error_mwh,
               {r('abs_error_mwh', 6)} AS abs_error_mwh, {r('abs_pct_error', 6)} AS abs_pct_error, bias_direction
        FROM feed_accuracy""",
)
def _accuracy(spark, sf_dir):
    rows = feeder_gold(spark, sf_dir)["fact_forecast_accuracy"]
    return rounded(rows, 6, "error_mwh", "abs_error_mwh", "abs_pct_error")


@register("pivot_measures", "SELECT * FROM event_wide")
def _pivot(spark, sf_dir):
    return pivot_measures(upsert_measures(None, adapters.event_measures(spark, sf_dir), ["seq"]))


register("pivot_latest", "SELECT * FROM feed_wide")(feeder_wide)
register(
    "series_bounds", "SELECT ba_code, min(period_utc) AS lo, max(period_utc) AS hi FROM feed_long GROUP BY ba_code"
)(lambda s, d: series_bounds(adapters.feeder_measures(s, d)))
register("hourly_spine", "SELECT ba_code, period_utc FROM feed_spine")(
    lambda s, d: hourly_spine(series_bounds(adapters.feeder_measures(s, d)))
)


@register(
    "demand_bounds",
    f"SELECT ba_code, {r('median_demand', 4)} AS median_demand, {r('lower_bound', 4)} AS lower_bound, "
    f"{r('upper_bound', 4)} AS upper_bound FROM feed_bounds",
)
def _bounds(spark, sf_dir):
    from wattloom.plans.warehouse import demand_bounds

    found = demand_bounds(feeder_wide(spark, sf_dir))
    return rounded(found, 4, "median_demand", "lower_bound", "upper_bound")


@register(
    "price_quantiles",
    f"""SELECT l_returnflag, {r('quantile_cont(l_extendedprice, 0.25)', 4)} AS q25,
               {r('quantile_cont(l_extendedprice, 0.5)', 4)} AS q50, {r('quantile_cont(l_extendedprice, 0.95)', 4)} AS q95
        FROM lineitem GROUP BY l_returnflag""",
)
def _price_quantiles(spark, sf_dir):
    lines = adapters.table(spark, sf_dir, "lineitem")
    found = grouped_quantiles(lines, ["l_returnflag"], "l_extendedprice", {"q25": 0.25, "q50": 0.5, "q95": 0.95})
    return rounded(found, 4, "q25", "q50", "q95")


view(
    "stg_demand",
    """
    SELECT period_utc, ba_code, date_local, hour_local, demand_mwh, demand_forecast_mwh, net_generation_mwh,
           total_interchange_mwh, temperature_2m, apparent_temperature, relative_humidity_2m, cloud_cover, wind_speed_10m,
           greatest(18.0::DOUBLE - temperature_2m, 0) AS heating_degrees,
           greatest(temperature_2m - 18.0::DOUBLE, 0) AS cooling_degrees,
           net_generation_mwh - demand_mwh AS generation_surplus_mwh,
           is_weekend, is_holiday, is_business_day, season, month, year,
           CASE WHEN is_holiday THEN 'Holiday' WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type
    FROM feed_fact WHERE demand_mwh > 0
    """,
)
view("stg_accuracy", "SELECT * FROM feed_accuracy WHERE actual_mwh > 0")
# Marts from lists: each group's values are gathered in order once, and every figure is read off the list.
view(
    "day_lists",
    """
    SELECT ba_code, date_local, day_type, season, list(demand_mwh ORDER BY period_utc) AS load, list(hour_local ORDER BY period_utc) AS clock,
           list(temperature_2m) FILTER (temperature_2m IS NOT NULL) AS warmth, list(heating_degrees) AS heating, list(cooling_degrees) AS cooling
    FROM stg_demand GROUP BY ALL
    """,
)
view(
    "mart_daily",
    f"""
    SELECT ba_code, date_local, day_type, season, len(load) AS hours_reported, {r('list_sum(load)')} AS total_demand_mwh,
           {r('list_avg(load)')} AS mean_demand_mw, {r('list_max(load)')} AS peak_demand_mw, {r('list_min(load)')} AS trough_demand_mw,
           {r('list_max(load) - list_min(load)')} AS daily_swing_mw, {r('list_avg(load) / nullif(list_max(load), 0)', 4)} AS load_factor,
           {r('list_avg(warmth)', 2)} AS mean_temp_c, {r('list_max(warmth)', 2)} AS max_temp_c, {r('list_min(warmth)', 2)} AS min_temp_c,
           {r('list_sum(heating) / 24', 2)} AS heating_degree_days, {r('list_sum(cooling) / 24', 2)} AS cooling_degree_days,
           clock[list_position(load, list_max(load))] AS peak_hour_local
    FROM day_lists
    """,
)

_ROUNDED = ("heating_degrees", "cooling_degrees", "generation_surplus_mwh")


@register(
    "stg_demand_hourly",
    f"SELECT * REPLACE ({', '.join(r(c, 6) + ' AS ' + c for c in _ROUNDED)}) FROM stg_demand",
)
def _stage(spark, sf_dir):
    rows = marts.stage_demand(feeder_gold(spark, sf_dir)["fact_demand_hourly"])
    return rounded(rows, 6, *_ROUNDED)


@register(
    "stg_forecast_accuracy",
    f"SELECT * REPLACE ({r('error_mwh', 6)} AS error_mwh, {r('abs_error_mwh', 6)} AS abs_error_mwh, "
    f"{r('abs_pct_error', 6)} AS abs_pct_error) FROM stg_accuracy",
)
def _stage_accuracy(spark, sf_dir):
    rows = marts.stage_accuracy(feeder_gold(spark, sf_dir)["fact_forecast_accuracy"])
    return rounded(rows, 6, "error_mwh", "abs_error_mwh", "abs_pct_error")


def _hourly(spark, sf_dir):
    return marts.stage_demand(feeder_gold(spark, sf_dir)["fact_demand_hourly"])


register("mart_daily_demand", "SELECT * FROM mart_daily")(lambda s, d: marts.daily_demand(_hourly(s, d)))

view(
    "profile_cells",
    f"""
    SELECT ba_code, season, day_type, hour_local, len(load) AS observations, {r('list_avg(load)')} AS mean_demand_mw,
           {r("list_aggregate(load, 'quantile_cont', 0.1)")} AS p10_demand_mw, {r("list_aggregate(load, 'quantile_cont', 0.9)")} AS p90_demand_mw
    FROM (SELECT ba_code, season, day_type, hour_local, list(demand_mwh) AS load FROM stg_demand GROUP BY ALL)
    """,
)
register(
    "mart_load_profile",
    f"""
    SELECT profile_cells.*, {r('mean_demand_mw / nullif(level, 0)', 4)} AS shape_index
    FROM profile_cells JOIN (SELECT ba_code, season, day_type, avg(mean_demand_mw) AS level FROM profile_cells GROUP BY ALL)
         USING (ba_code, season, day_type)
    """,
)(lambda s, d: marts.load_profile(_hourly(s, d)))

register(
    "mart_forecast_scorecard",
    f"""
    SELECT ba_code, month_local, len(pct) AS hours_scored, {r('list_avg(pct)', 3)} AS eia_mape_pct, {r('list_median(pct)', 3)} AS eia_median_ape_pct,
           {r("list_aggregate(pct, 'quantile_cont', 0.95)", 3)} AS eia_p95_ape_pct,
           {r('list_avg(list_transform(miss, lambda x: abs(x)))')} AS eia_mae_mw, {r('sqrt(list_avg(list_transform(miss, lambda x: x * x)))')} AS eia_rmse_mw,
           {r('list_avg(miss)')} AS mean_bias_mw, {r('len(list_filter(miss, lambda x: x > 0)) * 100::DOUBLE / len(miss)', 1)} AS over_forecast_pct
    FROM (SELECT ba_code, make_date(year(date_local), month(date_local), 1)::TIMESTAMP AS month_local, list(abs_pct_error) AS pct, list(error_mwh) AS miss
          FROM stg_accuracy GROUP BY ALL)
    """,
)(lambda s, d: marts.forecast_scorecard(marts.stage_accuracy(feeder_gold(s, d)["fact_forecast_accuracy"])))

view(
    "warm_hours",
    """
    SELECT ba_code, day_type, demand_mwh, (2 * floor(temperature_2m / 2))::INTEGER AS temp_bin_c, median(demand_mwh) OVER (PARTITION BY ba_code) AS middle
    FROM stg_demand WHERE temperature_2m IS NOT NULL
    """,
)
register(
    "mart_temperature_response",
    f"""
    SELECT ba_code, day_type, temp_bin_c, len(load) AS observations, {r('list_avg(load)')} AS mean_demand_mw,
           {r('list_avg(load) / nullif(middle, 0)', 4)} AS demand_index, {r('list_stddev_samp(load)')} AS demand_stddev_mw
    FROM (SELECT ba_code, day_type, temp_bin_c, middle, list(demand_mwh) AS load FROM warm_hours GROUP BY ALL)
    WHERE len(load) > 9
    """,
)(lambda s, d: marts.temperature_response(_hourly(s, d)))

register(
    "mart_peak_events",
    f"""
    SELECT day.ba_code, day.date_local, day.day_type, day.season, day.peak_demand_mw, day.peak_hour_local, day.max_temp_c, day.min_temp_c, day.load_factor,
           nth AS peak_rank, {r('day.peak_demand_mw * 100::DOUBLE / nullif(days[1].peak_demand_mw, 0)', 2)} AS pct_of_all_time_peak
    FROM (SELECT days, unnest(days[1:25]) AS day, unnest(range(1, least(len(days), 25) + 1)) AS nth
          FROM (SELECT list(mart_daily ORDER BY peak_demand_mw DESC, date_local) AS days FROM mart_daily GROUP BY ba_code))
    """,
)(lambda s, d: marts.peak_events(marts.daily_demand(_hourly(s, d))))
