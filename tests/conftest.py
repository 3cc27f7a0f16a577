"""One session, and a synthetic grid with known answers."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wattloom.operators.series import pivot_measures  # noqa: E402
from wattloom.plans.warehouse import build_gold  # noqa: E402
from wattloom.registry import authorities  # noqa: E402
from wattloom.session import local_session, release, written  # noqa: E402

HOURS = 4200
START = "2023-08-01 00:00:00"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "wattloom-tests")
    yield session
    release(session)
    session.stop()


@pytest.fixture(scope="session")
def grid(spark):
    """Hourly demand of three authorities with daily, weekly and temperature effects; no faults."""
    keys = spark.createDataFrame([("PJM", 90000.0), ("ERCO", 55000.0), ("CISO", 30000.0)], "ba_code string, scale double")
    hours = spark.range(HOURS).selectExpr("id", f"timestamp'{START}' + make_interval(0,0,0,0,cast(id as int),0,0) as period_utc")
    rows = keys.join(hours.hint("broadcast"))
    noise = "(pmod(xxhash64(ba_code, id, '{}'), 10000L) / 10000D - 0.5D)"
    return rows.selectExpr(
        "period_utc", "ba_code", "id", "scale",
        f"""round(15 + 12 * sin(2 * pi() * id / 8766) + 5 * sin(2 * pi() * id / 24) + 2 * {noise.format('t')}
            + 12 * (pmod(xxhash64(ba_code, id div 24), 10000L) / 10000D - 0.5D), 2) as temperature_2m""",
    ).selectExpr(
        "*",
        f"""round(scale * (1 + 0.18 * sin(2 * pi() * (id - 6) / 24)) * case when weekday(period_utc) >= 5 then 0.88 else 1 end
            * (1 + 0.012 * greatest(temperature_2m - 18, 0) + 0.008 * greatest(18 - temperature_2m, 0))
            * (1 + 0.04 * {noise.format('d')}), 1) as demand_mwh""",
    ).selectExpr(
        "period_utc", "ba_code", "temperature_2m", "demand_mwh",
        f"round(demand_mwh * (1 + 0.07 * {noise.format('f')}), 1) as demand_forecast_mwh",
        "demand_mwh * 1.03D as net_generation_mwh",
        f"scale * 0.04 * {noise.format('i')} as total_interchange_mwh",
    )


@pytest.fixture(scope="session")
def bronze(grid):
    return grid.selectExpr(
        "period_utc", "ba_code",
        """stack(4, 'D', demand_mwh, 'DF', demand_forecast_mwh, 'NG', net_generation_mwh, 'TI', cast(total_interchange_mwh as double))
           as (measure_code, value_mwh)""",
        "timestamp'2024-03-01' as ingested_at_utc",
    )


@pytest.fixture(scope="session")
def weather(grid):
    others = ["relative_humidity_2m", "dew_point_2m", "apparent_temperature", "cloud_cover", "wind_speed_10m", "shortwave_radiation"]
    return grid.selectExpr("period_utc", "temperature_2m", *[f"10D as {c}" for c in others], "ba_code")


@pytest.fixture(scope="session")
def gold(spark, bronze, weather):
    tables = build_gold(written(pivot_measures(bronze), "wide"), authorities(spark, "PJM,ERCO,CISO"), weather)
    fact = written(tables["fact_demand_hourly"], "fact")
    silver = written(tables["silver_grid_hourly"], "silver")
    accuracy = written(tables["fact_forecast_accuracy"], "accuracy")
    return {**tables, "fact_demand_hourly": fact, "silver_grid_hourly": silver, "fact_forecast_accuracy": accuracy}
