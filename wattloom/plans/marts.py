"""Staging projections and the five summary marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.scalars import bin_floor, day_type, half_up, ratio
from wattloom.operators.quantiles import with_group_median
from wattloom.schemas import BALANCE_POINT_C

PEAK_EVENTS = 25
MIN_OBSERVATIONS = 10


def _agg(df: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.expr(text).alias(name) for name, text in columns.items()])


def stage_demand(fact: DataFrame, balance_point: float = BALANCE_POINT_C) -> DataFrame:
    """Positive hours with degree split, surplus and day type.

    Degrees of an hour without a temperature are 0 here (``greatest`` skips NULL), unlike the
    model features, which keep the NULL.
    """
    return fact.where("demand_mwh > 0").selectExpr(
        "period_utc", "ba_code", "date_local", "hour_local",
        "demand_mwh", "demand_forecast_mwh", "net_generation_mwh", "total_interchange_mwh",
        "temperature_2m", "apparent_temperature", "relative_humidity_2m", "cloud_cover", "wind_speed_10m",
        f"greatest({balance_point}D - temperature_2m, 0D) as heating_degrees",
        f"greatest(temperature_2m - {balance_point}D, 0D) as cooling_degrees",
        "net_generation_mwh - demand_mwh as generation_surplus_mwh",
        "is_weekend", "is_holiday", "is_business_day", "season", "month", "year",
        f"{day_type()} as day_type",
    )


def stage_accuracy(accuracy: DataFrame) -> DataFrame:
    return accuracy.where("actual_mwh > 0").select(
        "period_utc", "ba_code", "date_local", "hour_local", "actual_mwh", "eia_forecast_mwh",
        "error_mwh", "abs_error_mwh", "abs_pct_error", "bias_direction",
    )


def daily_demand(hourly: DataFrame) -> DataFrame:
    """Daily totals, swing, load factor, degree days and the first hour of the daily peak."""
    x, t = "demand_mwh", "temperature_2m"
    return _agg(
        hourly,
        ["ba_code", "date_local", "day_type", "season"],
        {
            "hours_reported": "count(*)",
            "total_demand_mwh": half_up(f"sum({x})"),
            "mean_demand_mw": half_up(f"avg({x})"),
            "peak_demand_mw": half_up(f"max({x})"),
            "trough_demand_mw": half_up(f"min({x})"),
            "daily_swing_mw": half_up(f"max({x}) - min({x})"),
            "load_factor": half_up(ratio(f"avg({x})", f"max({x})"), 4),
            "mean_temp_c": half_up(f"avg({t})", 2),
            "max_temp_c": half_up(f"max({t})", 2),
            "min_temp_c": half_up(f"min({t})", 2),
            "heating_degree_days": half_up("sum(heating_degrees) / 24", 2),
            "cooling_degree_days": half_up("sum(cooling_degrees) / 24", 2),
            "peak_hour_local": f"max_by(hour_local, struct({x}, -unix_seconds(period_utc)))",
        },
    )


def load_profile(hourly: DataFrame) -> DataFrame:
    """Mean, P10 and P90 load by season, day type and hour, and the shape of each profile.

    A group holds one hour of the day within one season, at most 92 readings a year of one
    series, so its sorted values stay few however long the history is. They are ranked by one shuffle of the keys and
    the reading; a percentile aggregate would carry and spill a map of values a group.
    """
    keys = ["ba_code", "season", "day_type", "hour_local"]
    group = f"partition by {', '.join(keys)}"
    ranked = hourly.selectExpr(
        *keys, "demand_mwh",
        f"row_number() over ({group} order by demand_mwh) - 1 as _rank",
        f"count(1) over ({group}) - 1 as _last",
    )

    def tail(p: float) -> str:
        """Linear interpolation between the readings around a share of the ranks."""
        at = f"({p}D * _last)"
        share = f"case when _rank = floor({at}) then 1 - ({at} - floor({at})) when _rank = ceil({at}) then {at} - floor({at}) end"
        return f"sum(demand_mwh * {share})"

    grouped = _agg(
        ranked,
        keys,
        {
            "mean_demand_mw": half_up("avg(demand_mwh)"),
            "_p10": tail(0.1),
            "_p90": tail(0.9),
            "observations": "count(*)",
        },
    )
    level = "avg(mean_demand_mw) over (partition by ba_code, season, day_type)"
    return grouped.selectExpr(
        *keys, "mean_demand_mw",
        f"{half_up('_p10')} as p10_demand_mw",
        f"{half_up('_p90')} as p90_demand_mw",
        "observations",
        f"{half_up(ratio('mean_demand_mw', level), 4)} as shape_index",
    )


def forecast_scorecard(accuracy: DataFrame) -> DataFrame:
    """Monthly accuracy and bias of the published forecast (a group is one month of one series)."""
    months = accuracy.selectExpr("*", "date_trunc('month', date_local) as month_local")
    return _agg(
        months,
        ["ba_code", "month_local"],
        {
            "hours_scored": "count(*)",
            "eia_mape_pct": half_up("avg(abs_pct_error)", 3),
            "eia_median_ape_pct": half_up("percentile(abs_pct_error, 0.5)", 3),
            "eia_p95_ape_pct": half_up("percentile(abs_pct_error, 0.95)", 3),
            "eia_mae_mw": half_up("avg(abs_error_mwh)"),
            "eia_rmse_mw": half_up("sqrt(avg(error_mwh * error_mwh))"),
            "mean_bias_mw": half_up("avg(error_mwh)"),
            "over_forecast_pct": half_up("100D * count_if(bias_direction = 'over') / count(*)", 1),
        },
    )


def temperature_response(hourly: DataFrame) -> DataFrame:
    """Demand by two-degree bin, indexed on the key's own median; thin bins are left out."""
    rows = with_group_median(hourly.where("temperature_2m is not null"), ["ba_code"], "demand_mwh", "_median")
    return _agg(
        rows.selectExpr("*", f"{bin_floor('temperature_2m', 2.0)} as temp_bin_c"),
        ["ba_code", "day_type", "temp_bin_c"],
        {
            "observations": "count(*)",
            "mean_demand_mw": half_up("avg(demand_mwh)"),
            "demand_index": half_up(ratio("avg(demand_mwh)", "max(_median)"), 4),
            "demand_stddev_mw": half_up("stddev_samp(demand_mwh)"),
        },
    ).where(f"observations >= {MIN_OBSERVATIONS}")


def peak_events(daily: DataFrame, top: int = PEAK_EVENTS) -> DataFrame:
    """The highest-peak days of each key; equal peaks rank by date.

    Ranks are limited before the shuffle, so no key's whole history meets in one task; the
    all-time peak is the peak of the first rank.
    """
    ranked = daily.selectExpr(
        "*", "row_number() over (partition by ba_code order by peak_demand_mw desc, date_local) as peak_rank"
    ).where(f"peak_rank <= {top}")
    best = "max(peak_demand_mw) over (partition by ba_code)"
    return ranked.selectExpr(
        "ba_code", "date_local", "day_type", "season", "peak_demand_mw", "peak_hour_local", "max_temp_c",
        "min_temp_c", "load_factor", "peak_rank",
        f"{half_up(ratio('100D * peak_demand_mw', best), 2)} as pct_of_all_time_peak",
    )


def build_marts(fact: DataFrame, accuracy: DataFrame) -> dict[str, DataFrame]:
    hourly, scored = stage_demand(fact), stage_accuracy(accuracy)
    daily = daily_demand(hourly)
    return {
        "stg_demand_hourly": hourly,
        "stg_forecast_accuracy": scored,
        "mart_daily_demand": daily,
        "mart_load_profile": load_profile(hourly),
        "mart_forecast_scorecard": forecast_scorecard(scored),
        "mart_temperature_response": temperature_response(hourly),
        "mart_peak_events": peak_events(daily),
    }
