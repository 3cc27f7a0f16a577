"""Silver spine, calendar dimension and the two gold facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.holidays import calendar_columns
from wattloom.functions.scalars import hour_number, local_clock, ratio
from wattloom.operators.chunking import over_chunks
from wattloom.operators.quantiles import grouped_quantiles
from wattloom.operators.series import hourly_spine, series_bounds
from wattloom.schemas import (
    LOWER_FACTOR,
    MAX_RAMP_PCT,
    MEASURES,
    MIN_PLAUSIBLE_MWH,
    SPIKE_PCT,
    SPIKE_REACH,
    UPPER_FACTOR,
    WEATHER,
)
from wattloom.session import written

HOUR_KEY = ["ba_code", "period_utc"]
MEASURE_COLUMNS = list(MEASURES.values())
CALENDAR_COLUMNS = [
    "day_of_week", "is_weekend", "is_holiday", "is_business_day", "season", "month", "year",
    "is_day_before_holiday", "is_day_after_holiday",
]


def weather_or_nulls(rows: DataFrame, weather: DataFrame | None) -> DataFrame:
    """Join weather on the hour; without weather data the columns exist and are NULL."""
    if weather is None:
        return rows.selectExpr("*", *[f"cast(null as double) as {name}" for name in WEATHER])
    return rows.join(weather.select(*HOUR_KEY, *WEATHER).hint("merge"), HOUR_KEY, "left")


def hourly_frame(wide: DataFrame, bounds: DataFrame, dim_ba: DataFrame, weather: DataFrame | None) -> DataFrame:
    """Gap-free hourly rows with measures, weather and civil local time, before any flag.

    Spine, measures and weather are joined by sort-merge: the spine is generated, so its size is
    not visible in the statistics a broadcast would be decided on.
    """
    reported = wide.selectExpr("*", "true as _reported")
    rows = hourly_spine(bounds).hint("merge").join(reported, HOUR_KEY, "left")
    rows = weather_or_nulls(rows, weather).join(dim_ba.select("ba_code", "timezone"), "ba_code")
    return rows.selectExpr("*", f"{local_clock()} as period_local")


def neighbour_columns() -> dict[str, str]:
    """The previous reading and the readings within reach of each hour, for the gold flags."""
    return {"_previous": "lag(demand_mwh) over ({w})", "_near": local_values("demand_mwh", SPIKE_REACH)}


def flagged_hours(rows: DataFrame) -> DataFrame:
    """Silver columns plus the neighbours the gold flags need, all from one shuffle of the hours."""
    frozen = """demand_mwh is not null and demand_mwh = lag(demand_mwh) over ({w})
                and demand_mwh = lag(demand_mwh, 2) over ({w})"""
    flagged = over_chunks(
        rows, ["ba_code"], hour_number(), SPIKE_REACH, SPIKE_REACH, {"flag_frozen_reading": frozen, **neighbour_columns()}
    )
    return flagged.selectExpr(
        *HOUR_KEY[::-1], "timezone", "period_local",
        "to_date(period_local) as date_local",
        "hour(period_local) as hour_local",
        "weekday(period_local) + 1 as iso_dow_local",
        *MEASURE_COLUMNS, *WEATHER,
        "demand_mwh is null as flag_missing_demand",
        f"demand_mwh is not null and demand_mwh < {MIN_PLAUSIBLE_MWH}D as flag_nonpositive_demand",
        "_reported is null as flag_absent_interval",
        "flag_frozen_reading",
        *neighbour_columns(),
    )


def build_silver(wide: DataFrame, dim_ba: DataFrame, weather: DataFrame | None = None, bounds: DataFrame | None = None) -> DataFrame:
    """``silver_grid_hourly``: the hourly spine with quality flags; nothing is dropped."""
    rows = hourly_frame(wide, bounds if bounds is not None else series_bounds(wide), dim_ba, weather)
    return flagged_hours(rows).drop(*neighbour_columns())


def build_dim_date(days: DataFrame, extra_days: int = 20) -> DataFrame:
    """Calendar from the first to the last ``date_local``, plus a margin for the future.

    Holiday adjacency is false where the neighbouring day lies outside the calendar.
    """
    span = days.agg(F.min("date_local").alias("_lo"), F.date_add(F.max("date_local"), extra_days).alias("_hi"))
    attributes = calendar_columns("date_day")
    attributes["is_day_before_holiday"] += " and date_day < _hi"
    attributes["is_day_after_holiday"] += " and date_day > _lo"
    return span.selectExpr("_lo", "_hi", "explode(sequence(_lo, _hi)) as date_day").selectExpr(
        "date_day", *[f"({text}) as {name}" for name, text in attributes.items()]
    )


def demand_bounds(demand: DataFrame) -> DataFrame:
    """Median of the positive readings of each key and the plausible band around it."""
    median = grouped_quantiles(demand.where("demand_mwh > 0"), ["ba_code"], "demand_mwh", {"median_demand": 0.5})
    return median.selectExpr(
        "ba_code",
        "median_demand",
        f"median_demand * {LOWER_FACTOR}D as lower_bound",
        f"median_demand * {UPPER_FACTOR}D as upper_bound",
    )


def local_values(value: str, reach: int) -> str:
    """The known values within ``reach`` rows of this one, sorted; fewer at the ends of a series."""
    offsets = [f"lag({value}, {i}) over ({{w}})" for i in range(reach, 0, -1)]
    offsets += [value] + [f"lead({value}, {i}) over ({{w}})" for i in range(1, reach + 1)]
    return f"sort_array(array_compact(array({', '.join(offsets)})))"


def build_fact(silver: DataFrame, dim_date: DataFrame, bounds: DataFrame) -> DataFrame:
    """``fact_demand_hourly``: raw and trusted demand, ramp, magnitude and spike flags, calendar.

    A stored silver table gets its neighbours here; ``flagged_hours`` already carries them.
    """
    rows = silver
    if "_near" not in rows.columns:
        rows = over_chunks(rows, ["ba_code"], hour_number(), SPIKE_REACH, SPIKE_REACH, neighbour_columns())
    middle = "(get(_near, cast((size(_near) - 1) div 2 as int)) + get(_near, cast(size(_near) div 2 as int))) / 2"
    departs = f"({ratio('abs(demand_mwh - _median)', '_median')} * 100 > {SPIKE_PCT}D)"
    return (
        rows.selectExpr("*", f"case when size(_near) > 0 then {middle} end as _median")
        .join(bounds, "ba_code", "left")
        .join(dim_date.withColumnRenamed("date_day", "date_local").select("date_local", *CALENDAR_COLUMNS), "date_local", "left")
        .selectExpr(
            "period_utc", "ba_code", "date_local", "hour_local", *MEASURE_COLUMNS, *WEATHER,
            f"""case when demand_mwh is not null and not flag_nonpositive_demand
                      and demand_mwh between lower_bound and upper_bound
                      and not (_median is not null and {departs}) then demand_mwh end as demand_clean_mwh""",
            "flag_missing_demand", "flag_nonpositive_demand", "flag_frozen_reading",
            f"{ratio('abs(demand_mwh - _previous)', '_previous')} * 100 > {MAX_RAMP_PCT}D as flag_extreme_ramp",
            "demand_mwh is not null and (demand_mwh < lower_bound or demand_mwh > upper_bound) as flag_implausible_magnitude",
            f"demand_mwh is not null and _median is not null and {departs} as flag_isolated_spike",
            *CALENDAR_COLUMNS,
        )
    )


def build_accuracy(fact: DataFrame) -> DataFrame:
    """``fact_forecast_accuracy``: error of the published forecast against trusted demand."""
    error = "(demand_forecast_mwh - demand_clean_mwh)"
    return fact.where("demand_clean_mwh is not null and demand_forecast_mwh is not null").selectExpr(
        "period_utc", "ba_code", "date_local", "hour_local",
        "demand_clean_mwh as actual_mwh",
        "demand_forecast_mwh as eia_forecast_mwh",
        f"{error} as error_mwh",
        f"abs({error}) as abs_error_mwh",
        f"{ratio(f'abs({error})', 'demand_clean_mwh')} * 100 as abs_pct_error",
        "case when demand_forecast_mwh > demand_clean_mwh then 'over' else 'under' end as bias_direction",
    )


def calendar_span(bounds: DataFrame, dim_ba: DataFrame) -> DataFrame:
    """The local dates on which the series begin and end, straight from the series bounds."""
    ends = bounds.join(dim_ba.select("ba_code", "timezone"), "ba_code")
    return ends.selectExpr("timezone", "explode(array(lo, hi)) as period_utc").selectExpr(
        f"to_date({local_clock()}) as date_local"
    )


def build_gold(wide: DataFrame, dim_ba: DataFrame, weather: DataFrame | None = None, bounds: DataFrame | None = None) -> dict[str, DataFrame]:
    """All data-layer tables as lazy plans over pivoted measures.

    The per-key figures (one row per key) are written first: joins with them are then planned on
    their real size, and the hourly rows are not shuffled by key for a table that can be broadcast.
    """
    bounds = written(bounds if bounds is not None else series_bounds(wide), "series_bounds")
    plausible = written(demand_bounds(wide), "demand_bounds")
    hours = flagged_hours(hourly_frame(wide, bounds, dim_ba, weather))
    dim_date = build_dim_date(calendar_span(bounds, dim_ba))
    fact = build_fact(hours, dim_date, plausible)
    return {
        "dim_ba": dim_ba,
        "dim_date": dim_date,
        "silver_grid_hourly": hours.drop(*neighbour_columns()),
        "fact_demand_hourly": fact,
        "fact_forecast_accuracy": build_accuracy(fact),
    }
