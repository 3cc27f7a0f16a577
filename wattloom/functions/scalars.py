"""Expressions shared by the plans, as SQL text.

Text is handed to Spark in one call per column, where a chain of Column calls costs one round
trip to the JVM per operation; everything stays inside the JVM either way.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.schemas import BALANCE_POINT_C


def half_up(value: str, digits: int = 0) -> str:
    """Round half away from zero on the decimal value.

    The cast to a decimal five digits finer absorbs the last-bit noise that the order of a
    distributed sum leaves behind, so published figures do not depend on the partitioning.
    """
    return f"cast(round(cast({value} as decimal(38,{digits + 5})), {digits}) as double)"


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """The frame with the named columns rounded half away from zero."""
    return df.withColumns({c: F.expr(half_up(c, digits)) for c in columns})


def finite(value: str) -> str:
    """True for a number that is neither NULL, NaN nor infinite."""
    return f"({value} is not null and not isnan({value}) and abs({value}) < double('Infinity'))"


def only_finite(value: str) -> str:
    """NaN and the infinities become NULL."""
    return f"case when {finite(value)} then {value} end"


def ratio(top: str, bottom: str) -> str:
    """Division with NULL for a zero divisor."""
    return f"(({top}) / nullif({bottom}, 0D))"


def clip_low(value: str, low: float) -> str:
    """Lower bound that keeps NULL (``greatest`` alone would turn NULL into the bound)."""
    return f"case when ({value}) is not null then greatest({value}, {low}D) end"


def heating(temp: str = "temperature_2m", balance: float = BALANCE_POINT_C) -> str:
    return clip_low(f"{balance}D - {temp}", 0.0)


def cooling(temp: str = "temperature_2m", balance: float = BALANCE_POINT_C) -> str:
    return clip_low(f"{temp} - {balance}D", 0.0)


def cyclical(value: str, period: float, name: str) -> dict[str, str]:
    """Sine and cosine of a value on a circle of the given period."""
    angle = f"{2 * math.pi!r}D * ({value}) / {period}D"
    return {f"{name}_sin": f"sin({angle})", f"{name}_cos": f"cos({angle})"}


def hour_number(period: str = "period_utc") -> str:
    """Whole hours since the epoch: the position of a row on an hourly series."""
    return f"floor(unix_seconds({period}) / 3600)"


def local_clock(timezone: str = "timezone", period: str = "period_utc") -> str:
    """Civil local time of a UTC instant, as a timestamp without zone."""
    return f"convert_timezone('UTC', {timezone}, cast({period} as timestamp_ntz))"


def iso_z(period: str = "period_utc") -> str:
    return f"date_format({period}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"


def hour_stamp(period: str) -> str:
    """Watermark text, hour precision."""
    return f"date_format({period}, \"yyyy-MM-dd'T'HH\")"


def parse_hour_stamp(text: str) -> str:
    return f"try_to_timestamp({text}, \"yyyy-MM-dd'T'HH\")"


def number_or_null(text: str) -> str:
    """Numeric coercion of text: anything unreadable, and NaN, becomes NULL."""
    return only_finite(f"try_cast({text} as double)")


def day_type(is_holiday: str = "is_holiday", is_weekend: str = "is_weekend") -> str:
    return f"case when {is_holiday} then 'Holiday' when {is_weekend} then 'Weekend' else 'Weekday' end"


def severity(votes: str) -> str:
    return f"case when {votes} <= 0 then 'none' when {votes} = 1 then 'low' when {votes} = 2 then 'medium' else 'high' end"


def row_mean(columns: list[str]) -> str:
    """Mean across columns of one row, NULLs left out."""
    total = " + ".join(f"coalesce({c}, 0D)" for c in columns)
    present = " + ".join(f"cast({c} is not null as int)" for c in columns)
    return ratio(total, f"cast({present} as double)")


def sorted_row(columns: list[str]) -> dict[str, str]:
    """The values of the columns in ascending order, under the same names (no crossing)."""
    ordered = f"array_sort(array({', '.join(columns)}))"
    return {c: f"get({ordered}, {i})" for i, c in enumerate(columns)}


def bin_half_even(value: str, width: float) -> str:
    """Nearest multiple of ``width``, halves to the even multiple."""
    return f"bround({value} / {width}D, 0) * {width}D"


def bin_floor(value: str, width: float) -> str:
    return f"cast(floor({value} / {width}D) * {width}D as int)"


def exprs(columns: dict[str, str]) -> dict[str, Column]:
    return {name: F.expr(text) for name, text in columns.items()}


def without_zone(df: DataFrame) -> DataFrame:
    """UTC instants as plain timestamps, for sinks and readers that know no zones."""
    zoned = {f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}
    if not zoned:
        return df
    return df.selectExpr(*[f"cast(`{c}` as timestamp_ntz) as `{c}`" if c in zoned else f"`{c}`" for c in df.columns])
