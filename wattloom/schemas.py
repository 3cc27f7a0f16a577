"""Column names, constants and explicit schemas of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Measure codes and their columns.
MEASURES = {
    "D": "demand_mwh",
    "DF": "demand_forecast_mwh",
    "NG": "net_generation_mwh",
    "TI": "total_interchange_mwh",
}

# Weather variables.
WEATHER = (
    "temperature_2m",
    "relative_humidity_2m",
    "dew_point_2m",
    "apparent_temperature",
    "cloud_cover",
    "wind_speed_10m",
    "shortwave_radiation",
)

# Thresholds.
MIN_PLAUSIBLE_MWH = 1.0
MAX_RAMP_PCT = 40.0
SPIKE_REACH = 2
SPIKE_PCT = 20.0
LOWER_FACTOR = 0.2
UPPER_FACTOR = 5.0
BALANCE_POINT_C = 18.0
HORIZON = 24
LOOKBACK = 168
QUANTILES = (0.1, 0.5, 0.9)

# Feed window rules.
FEED_EPOCH = "2015-07-01"
DEFAULT_START = "2019-01-01"
OVERLAP_HOURS = 24
AHEAD_HOURS = 48
ARCHIVE_LAG_DAYS = 6
ARCHIVE_SOURCE = "era5_archive"
FORECAST_SOURCE = "forecast"

# Tables owned by the data layers, and the model outputs a rebuild makes stale.
DATA_TABLES = ("dim_ba", "dim_date", "silver_grid_hourly", "fact_demand_hourly", "fact_forecast_accuracy")
MODEL_TABLES = ("model_scores", "model_predictions", "anomaly_scores")
QUERY_TABLES = DATA_TABLES + MODEL_TABLES + ("dq_results", "dq_scorecard")


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


BRONZE_MEASURES = _struct(
    ("period_utc", T.TimestampType()),
    ("ba_code", T.StringType()),
    ("measure_code", T.StringType()),
    ("value_mwh", T.DoubleType()),
    ("ingested_at_utc", T.TimestampType()),
)

BRONZE_WEATHER = _struct(
    ("period_utc", T.TimestampType()),
    *((name, T.DoubleType()) for name in WEATHER),
    ("ba_code", T.StringType()),
    ("source", T.StringType()),
    ("ingested_at_utc", T.TimestampType()),
)

DIM_BA = _struct(
    ("ba_code", T.StringType()),
    ("ba_name", T.StringType()),
    ("timezone", T.StringType()),
    ("region", T.StringType()),
    ("load_centre", T.StringType()),
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
)

# Landing payloads: numerics arrive as strings and may be absent.
LANDING_MEASURES = _struct(
    (
        "response",
        _struct(
            ("total", T.StringType()),
            (
                "data",
                T.ArrayType(
                    _struct(
                        ("period", T.StringType()),
                        ("respondent", T.StringType()),
                        ("type", T.StringType()),
                        ("value", T.StringType()),
                    )
                ),
            ),
        ),
    )
)

LANDING_WEATHER = _struct(
    (
        "hourly",
        _struct(
            ("time", T.ArrayType(T.StringType())),
            *((name, T.ArrayType(T.StringType())) for name in WEATHER),
        ),
    )
)


def assert_columns(df, expected: T.StructType, layer: str) -> None:
    """Fail early when a layer's columns or types drift from the declared schema."""
    found = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{f.name}: expected {f.dataType.simpleString()}, found "
        f"{found[f.name].simpleString() if f.name in found else 'nothing'}"
        for f in expected.fields
        if found.get(f.name) != f.dataType
    ]
    if wrong:
        raise ValueError(f"{layer} does not match its schema: " + "; ".join(wrong))
