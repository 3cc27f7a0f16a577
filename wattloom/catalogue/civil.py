"""The feeder lake over a civil year: every season, and hours that the clocks skip or repeat.

The SQL derives local time by arithmetic from the rule of the clocks, never from a zone table.
"""

from __future__ import annotations

import re

from wattloom.catalogue import demand  # noqa: F401 - registers what is laid over the civil year here
from wattloom.catalogue.base import BODIES, STANDARD, VIEWS, civil, feeder_gold, register, sunday, view
from wattloom.functions.scalars import rounded
from wattloom.plans import marts
from wattloom.plans.diagnostics import clock_changes

_STEPS = ("stg_demand", "stg_accuracy", "day_lists", "mart_daily", "profile_cells", "warm_hours")


def _own(text: str) -> str:
    """A text over the feeder lake's staging and marts, over those of the civil year."""
    return re.sub(rf"\b({'|'.join(_STEPS)})\b", r"civil_\1", civil(text))


for _name in _STEPS:
    view(f"civil_{_name}", _own(VIEWS[_name]))


def _gold(spark, sf_dir):
    return feeder_gold(spark, sf_dir, civil=True)


def _hourly(spark, sf_dir):
    return marts.stage_demand(_gold(spark, sf_dir)["fact_demand_hourly"])


register("civil_silver_grid_hourly", "SELECT * FROM civil_silver")(lambda s, d: _gold(s, d)["silver_grid_hourly"])
register("civil_dim_date", "SELECT * FROM civil_dates")(lambda s, d: _gold(s, d)["dim_date"])
register("civil_fact_demand_hourly", "SELECT * FROM civil_fact")(lambda s, d: _gold(s, d)["fact_demand_hourly"])
register("civil_mart_daily_demand", _own(BODIES["mart_daily_demand"]))(lambda s, d: marts.daily_demand(_hourly(s, d)))
register("civil_mart_load_profile", _own(BODIES["mart_load_profile"]))(lambda s, d: marts.load_profile(_hourly(s, d)))
register("civil_mart_forecast_scorecard", _own(BODIES["mart_forecast_scorecard"]))(
    lambda s, d: marts.forecast_scorecard(marts.stage_accuracy(_gold(s, d)["fact_forecast_accuracy"]))
)
register("civil_mart_peak_events", _own(BODIES["mart_peak_events"]))(lambda s, d: marts.peak_events(marts.daily_demand(_hourly(s, d))))


@register("civil_fact_forecast_accuracy", _own(BODIES["fact_forecast_accuracy"]))
def _accuracy(spark, sf_dir):
    return rounded(_gold(spark, sf_dir)["fact_forecast_accuracy"], 6, "error_mwh", "abs_error_mwh", "abs_pct_error")


# The days are the rule's own; nothing is read off the hours but their number.
_DAY = "CAST(date_local AS TIMESTAMP)"
register(
    "clock_change_days",
    f"""
    SELECT ba_code, date_local, count(*) AS hours_in_day, count(*) - count(DISTINCT hour_local) AS hours_repeated,
           CASE WHEN spring THEN 0 ELSE 1 END - any_value(standard) AS offset_before, CASE WHEN spring THEN 1 ELSE 0 END - any_value(standard) AS offset_after
    FROM (SELECT ba_code, date_local, hour_local, {_DAY} = {sunday(3, 8)} AS spring, {_DAY} = {sunday(11, 1)} AS autumn, {STANDARD} AS standard
          FROM civil_silver d)
    WHERE spring OR autumn GROUP BY ba_code, date_local, spring
    """,
)(lambda s, d: clock_changes(_gold(s, d)["silver_grid_hourly"]))
