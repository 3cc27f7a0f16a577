"""Model features: calendar, lags, rolling statistics, weather, and chronological splits.

Everything derived from past demand is at least one forecast horizon old.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.scalars import cooling, cyclical, exprs, heating, hour_number
from wattloom.operators.chunking import POSITION, chunk_size, over_chunk_tables, over_chunks
from wattloom.operators.quantiles import grouped_quantiles
from wattloom.operators.series import carried_values
from wattloom.schemas import HORIZON, LOWER_FACTOR, UPPER_FACTOR
from wattloom.session import written

# Lags and rolling windows, in hours.
LAGS = (24, 25, 26, 48, 72, 168, 336)
ROLLING = (24, 168)
GAP_LIMIT = 6

WEATHER_INPUTS = [
    "temperature_2m", "apparent_temperature", "relative_humidity_2m", "dew_point_2m",
    "cloud_cover", "wind_speed_10m", "shortwave_radiation",
]
FLAGS = ["is_weekend", "is_holiday", "is_business_day", "is_day_before_holiday", "is_day_after_holiday"]
LAG_COLUMNS = [f"demand_lag_{h}h" for h in LAGS]
FEATURES = [
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "doy_sin", "doy_cos",
    *FLAGS,
    *LAG_COLUMNS,
    *[f"demand_roll_mean_{w}h" for w in ROLLING],
    *[f"demand_roll_std_{w}h" for w in ROLLING],
    "demand_same_hour_last_week_delta",
    *WEATHER_INPUTS,
    "heating_degrees", "cooling_degrees", "temp_squared",
    "temp_lag_24h", "temp_change_24h", "temp_roll_mean_24h",
    "cooling_x_business", "heating_x_business", "cooling_x_hour",
]
TARGET = "demand_mwh"
MODEL_COLUMNS = [
    "period_utc", "ba_code", "date_local", "hour_local", "demand_mwh", "demand_forecast_mwh", *WEATHER_INPUTS,
    "day_of_week", *FLAGS, "month", "year",
]


def modelling_frame(fact: DataFrame, codes: list[str] | None = None) -> DataFrame:
    """Trusted demand as the target, with the columns features need; optionally some keys only."""
    rows = fact if not codes else fact.where(F.col("ba_code").isin([c.upper() for c in codes]))
    return rows.drop("demand_mwh").withColumnRenamed("demand_clean_mwh", "demand_mwh").select(*MODEL_COLUMNS)


def implausible(target: str = TARGET) -> str:
    return f"({target} < _median * {LOWER_FACTOR}D or {target} > _median * {UPPER_FACTOR}D)"


def flag_implausible(frame: DataFrame, target: str = TARGET, name: str = "flag_implausible") -> DataFrame:
    """True where the target is far from the key's own median; an unknown target is not flagged."""
    median = written(grouped_quantiles(frame, ["ba_code"], target, {"_median": 0.5}), "key_medians")
    return frame.join(median, "ba_code", "left").selectExpr(*frame.columns, f"coalesce({implausible(target)}, false) as {name}")


def calendar_features(frame: DataFrame) -> DataFrame:
    """Positions on the daily, weekly and yearly circle, and calendar flags as 0 / 1."""
    circles = {
        **cyclical("hour_local", 24, "hour"),
        **cyclical("day_of_week", 7, "dow"),
        **cyclical("dayofyear(date_local)", 365.25, "doy"),
    }
    return frame.withColumns(exprs({**circles, **{f: f"cast(coalesce({f}, false) as int)" for f in FLAGS}}))


def _sums(value: str, name: str) -> dict[str, str]:
    """Running count, sum and sum of squares within a chunk, around the chunk's own mean."""
    upto = "over ({w} rows between unbounded preceding and current row)"
    return {
        f"_n_{name}": f"count({value}) {upto}",
        f"_s_{name}": f"sum({value} - _mean_{name}) {upto}",
        f"_q_{name}": f"sum(({value} - _mean_{name}) * ({value} - _mean_{name})) {upto}",
    }


def _between(running: str, newest: int, width: int) -> str:
    """Difference of a running figure over the ``width`` rows that end ``newest`` rows ago."""
    head = running if newest == 0 else f"lag({running}, {newest}) over ({{w}})"
    return f"coalesce({head}, 0) - coalesce(lag({running}, {newest + width}) over ({{w}}), 0)"


def rolling_steps(value: str, name: str, newest: int, widths: tuple[int, ...]) -> list[dict[str, str]]:
    """``rolling`` as window steps of ``over_chunks``: mean and sample deviation as differences of running sums.

    A sliding frame re-adds every row of the window for each row; differences of running sums
    cost the same for any width. Sums are taken around the chunk mean, and a spread below their
    resolution counts as zero. At least a quarter of the window must be present.
    """
    whole = "over ({w} rows between unbounded preceding and unbounded following)"
    steps = [
        {f"_mean_{name}": f"avg({value}) {whole}", f"_var_{name}": f"coalesce(var_pop({value}) {whole}, 0D)"},
        _sums(value, name),
        {
            f"_{kind}{w}_{name}": _between(f"_{kind}_{name}", newest, w)
            for w in widths
            for kind in ("n", "s", "q")
        },
    ]
    result = {}
    for w in widths:
        n, s, q = (f"_{kind}{w}_{name}" for kind in ("n", "s", "q"))
        spread = f"({q} - {s} * {s} / nullif({n}, 0)) / nullif({n} - 1, 0)"
        result[f"{name}_mean_{w}h"] = f"case when {n} >= {w // 4} then _mean_{name} + {s} / nullif({n}, 0) end"
        result[f"{name}_std_{w}h"] = (
            f"case when {n} >= {w // 4} then case when {spread} <= 1e-10D * _var_{name} then 0D else sqrt({spread}) end end"
        )
    return [*steps, result]


def _known(rows: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of a column, and which of them are known."""
    values = rows.column(column).cast(pa.float64())
    return values.to_numpy(), values.is_valid().to_numpy()


def _lag(values: np.ndarray, rows: int, first: float = np.nan) -> np.ndarray:
    """The value so many rows earlier."""
    earlier = np.full(len(values), first)
    earlier[rows:] = values[: max(len(values) - rows, 0)]
    return earlier


def rolling(values: np.ndarray, known: np.ndarray, newest: int, widths: tuple[int, ...]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Mean and sample deviation of the ``width`` rows that end ``newest`` rows ago, as differences of running sums.

    Sums are taken around the mean of all values, and a spread below their resolution counts as
    zero. At least a quarter of the window must be known.
    """
    counted = np.cumsum(known)
    total = int(counted[-1]) if len(counted) else 0
    mean = float(np.cumsum(np.where(known, values, 0.0))[-1]) / total if total else 0.0
    off = np.where(known, values - mean, 0.0)
    resolution = 1e-10 * float(np.mean(off[known] ** 2)) if total else 0.0
    running = [counted.astype(float), np.cumsum(off), np.cumsum(off * off)]
    result = {}
    for width in widths:
        n, s, q = (_lag(r, newest, 0.0) - _lag(r, newest + width, 0.0) for r in running)
        enough = n >= width // 4
        with np.errstate(divide="ignore", invalid="ignore"):
            spread = (q - s * s / n) / (n - 1)
            deviation = np.where(spread <= resolution, 0.0, np.sqrt(spread))
            result[width] = np.where(enough, mean + s / n, np.nan), np.where(enough, deviation, np.nan)
    return result


def filled(rows: pa.Table, edges: pa.Table, column: str, limit: int) -> np.ndarray:
    """Linear filling, at most ``limit`` rows from either side; ends take the nearest value."""
    values, known = _known(rows, column)
    position = rows.column(POSITION).to_numpy().astype(float)
    at = np.arange(len(values))

    def near(place: np.ndarray, inside: np.ndarray, side: str) -> tuple[np.ndarray, np.ndarray]:
        carried = [np.nan if not edges.num_rows else edges.column(f"_{side}{part}_{column}")[0].as_py() for part in "pv"]
        beyond = [np.nan if c is None else float(c) for c in carried]
        place = np.where(inside, place, 0)
        return np.where(inside, position[place], beyond[0]), np.where(inside, values[place], beyond[1])

    before = np.maximum.accumulate(np.where(known, at, -1))
    after = np.minimum.accumulate(np.where(known, at, len(at))[::-1])[::-1]
    bp, bv = near(before, before >= 0, "in")
    ap, av = near(after, after < len(at), "out")
    with np.errstate(divide="ignore", invalid="ignore"):
        between = bv + (av - bv) * (position - bp) / (ap - bp)
        reached = np.fmin(position - bp, ap - position) <= limit
    one = np.where(np.isnan(ap), bv, np.where(np.isnan(bp), av, between))
    return np.where(known, values, np.where(reached, one, np.nan))


ROLLED = {f"demand_roll_{figure}_{w}h": (w, i) for w in ROLLING for i, figure in enumerate(("mean", "std"))}
SERIES = [*LAG_COLUMNS, *ROLLED, "temp_roll_mean_24h", "temp_lag_24h", *[f"_filled_{c}" for c in WEATHER_INPUTS]]


def series_columns(rows: pa.Table, edges: pa.Table) -> dict[str, np.ndarray]:
    """What features need of other rows, from the rows of a chunk in order."""
    demand, known = _known(rows, TARGET)
    warmth, felt = _known(rows, "temperature_2m")
    rolled = rolling(demand, known, HORIZON, ROLLING)
    return {
        **{c: _lag(demand, h) for c, h in zip(LAG_COLUMNS, LAGS, strict=True)},
        **{name: rolled[width][figure] for name, (width, figure) in ROLLED.items()},
        "temp_roll_mean_24h": rolling(warmth, felt, 0, (24,))[24][0],
        "temp_lag_24h": _lag(warmth, 24),
        **{f"_filled_{c}": filled(rows, edges, c, GAP_LIMIT) for c in WEATHER_INPUTS},
    }


def series_features(frame: DataFrame) -> DataFrame:
    """Lags, rolling figures, weather features and interactions of a gap-free hourly frame.

    Derived weather features are taken from the raw weather, so they keep its gaps; the weather
    inputs themselves come out interpolated. One
    shuffle by (key, chunk) serves all of it.
    """
    keys, position = ["ba_code"], hour_number()
    back = max(*LAGS, HORIZON + max(ROLLING))
    size = chunk_size(back)
    carried = carried_values(frame, keys, position, WEATHER_INPUTS, size)
    wide = calendar_features(over_chunk_tables(frame, carried, keys, position, back, size, SERIES, series_columns))
    for step in (
        {
            "demand_same_hour_last_week_delta": "demand_lag_168h - demand_lag_336h",
            "heating_degrees": heating(),
            "cooling_degrees": cooling(),
            "temp_squared": "temperature_2m * temperature_2m",
            "temp_change_24h": "temperature_2m - temp_lag_24h",
        },
        {
            "cooling_x_business": "cooling_degrees * is_business_day",
            "heating_x_business": "heating_degrees * is_business_day",
            "cooling_x_hour": "cooling_degrees * hour_local",
        },
    ):
        wide = wide.withColumns(exprs(step))
    return wide.selectExpr(
        *[c for c in frame.columns if c not in FEATURES],
        *[f"_filled_{c} as {c}" if c in WEATHER_INPUTS else c for c in FEATURES],
    )


def _usable(rows: DataFrame, frame: DataFrame, dropna_target: bool) -> DataFrame:
    """Rows with all lags and, if asked for, a plausible target."""
    if dropna_target:
        median = written(grouped_quantiles(frame, ["ba_code"], TARGET, {"_median": 0.5}), "key_medians")
        rows = rows.join(median, "ba_code").where(f"{TARGET} is not null and not {implausible()}").drop("_median")
    return rows.where(" and ".join(f"{c} is not null" for c in LAG_COLUMNS))


def build_features(frame: DataFrame, dropna_target: bool = True) -> DataFrame:
    """The feature table models train on; keep unknown targets to feature future hours."""
    return _usable(series_features(frame), frame, dropna_target)


def featured_rows(frame: DataFrame, *columns: str) -> DataFrame:
    """Columns of the frame on the rows ``build_features`` has, at the cost of the lags alone."""
    lags = {c: f"lag({TARGET}, {h}) over ({{w}})" for c, h in zip(LAG_COLUMNS, LAGS, strict=True)}
    rows = frame.where("ba_code is not null")
    return _usable(over_chunks(rows, ["ba_code"], hour_number(), max(LAGS), 0, lags), frame, True).select(*columns)


def _last_period(frame: DataFrame):
    return frame.select(F.max("period_utc")).scalar()


def chronological_split(frame: DataFrame, test_days: int = 90, valid_days: int = 60, name: str = "split") -> DataFrame:
    """Label rows train / valid / test by date only; a cut-off hour belongs to the earlier part."""
    test = _last_period(frame) - F.expr(f"interval {test_days} days")
    valid = test - F.expr(f"interval {valid_days} days")
    p = F.col("period_utc")
    return frame.withColumn(name, F.when(p <= valid, "train").when(p <= test, "valid").otherwise("test"))


def training_split(frame: DataFrame, test_days: int = 90, valid_days: int = 60, name: str = "split", dated: DataFrame | None = None) -> DataFrame:
    """The training pipeline's labels: a cut-off hour belongs to the later part. ``dated`` has the hours of ``frame``, if they are cheaper there."""
    test = _last_period(frame if dated is None else dated) - F.expr(f"interval {test_days} days")
    valid = test - F.expr(f"interval {valid_days} days")
    p = F.col("period_utc")
    return frame.withColumn(name, F.when(p < valid, "train").when(p < test, "valid").otherwise("test"))
