"""Naive forecasts attached to a feature frame, and the seasonal-mean fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.scalars import hour_number
from wattloom.operators.chunking import over_chunks, with_ordinal, with_previous


def build_all_baselines(frame: DataFrame, target: str = "demand_mwh", time_exact: bool = False) -> DataFrame:
    """Seasonal, weekly and drift forecasts, and the published forecast, as ``pred_*`` columns.

    By default a lag counts rows of the frame, as the published scores do; where rows were
    dropped that is not the same hour. ``time_exact`` looks up the hour itself instead.
    """
    if time_exact:
        rows = frame
        for hours in (24, 168, 336):
            earlier = frame.selectExpr(
                "ba_code", f"period_utc + interval {hours} hours as period_utc", f"{target} as _lag{hours}"
            )
            rows = rows.join(earlier, ["ba_code", "period_utc"], "left")
    else:
        lags = {f"_lag{h}": f"lag({target}, {h}) over ({{w}})" for h in (24, 168, 336)}
        rows = over_chunks(with_ordinal(frame, ["ba_code"], "period_utc"), ["ba_code"], "ordinal", 336, 0, lags)
    published = ["demand_forecast_mwh as pred_eia_official"] if "demand_forecast_mwh" in frame.columns else []
    return rows.selectExpr(
        *frame.columns,
        "_lag24 as pred_seasonal_naive",
        "_lag168 as pred_weekly_naive",
        "_lag168 + 0.5D * (_lag168 - _lag336) as pred_drift_naive",
        *published,
    )


def seasonal_mean(frame: DataFrame, horizon: int, season: int = 24, seasons: int = 4, target: str = "demand_mwh") -> DataFrame:
    """Forecast each key by the mean of its last seasons at the same phase.

    Only the last ``season * seasons`` known values of a key matter; ranks are limited before the
    shuffle.
    """
    known = frame.where(f"{target} is not null").selectExpr(
        "ba_code", "period_utc", target, "row_number() over (partition by ba_code order by period_utc desc) as _back"
    )
    tail = known.where(f"_back <= {season * seasons}").selectExpr(
        "ba_code", "period_utc", target,
        "count(*) over (partition by ba_code) - _back as _index",
        "max(period_utc) over (partition by ba_code) as _last",
    )
    pattern = tail.groupBy("ba_code", F.expr(f"_index % {season}").alias("_phase")).agg(
        F.avg(target).alias("forecast_mwh"), F.max("_last").alias("_last")
    )
    steps = f"explode(filter(sequence(1, {horizon}), x -> (x - 1) % {season} = _phase)) as horizon_step"
    return pattern.selectExpr("ba_code", "_last", "forecast_mwh", steps).selectExpr(
        "ba_code", "timestamp_seconds(unix_seconds(_last) + horizon_step * 3600) as period_utc", "horizon_step", "forecast_mwh"
    )


def spine_breaks(frame: DataFrame) -> DataFrame:
    """Rows whose previous row is not exactly one hour earlier (a gap detector)."""
    marked = with_previous(frame, ["ba_code"], "period_utc", hour_number(), "_previous_hour")
    return marked.selectExpr("ba_code", "period_utc", f"{hour_number()} - _previous_hour as step_hours").where("step_hours <> 1")
