"""Series windows that do not put a whole key into one task.

A window partitioned by key gives one task per key, however long the series. Here a series is
cut into chunks of its position, each row near a border is copied into the neighbouring chunk
it can influence, and windows run per (key, chunk). Rows are kept only from their home chunk,
so results equal the one-window form as long as frames stay within ``back`` / ``ahead`` rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

Step = dict[str, str] | Callable[[DataFrame, str], DataFrame]

MIN_CHUNK = 2160
CHUNK, HOME, POSITION = "_chunk", "_home", "_position"


def chunk_size(back: int, ahead: int = 0) -> int:
    """At least 90 days of hours, and long enough that copies stay under a twelfth of the rows."""
    return max(MIN_CHUNK, 12 * max(back, ahead))


def spread_out(df: DataFrame, position: str, back: int, ahead: int, size: int) -> DataFrame:
    """Every row with its chunk and home chunk, and its copies in the chunks it can influence."""
    reach = f"sequence(floor(({position} - {ahead}) / {size}), floor(({position} + {back}) / {size}))"
    return df.selectExpr(
        "*",
        f"cast({position} as bigint) as {POSITION}",
        f"floor({position} / {size}) as {HOME}",
        f"explode({reach}) as {CHUNK}",
    )


def over_chunks(
    df: DataFrame,
    keys: list[str],
    position: str,
    back: int,
    ahead: int,
    *steps: Step,
    size: int | None = None,
) -> DataFrame:
    """Add window columns to bounded pieces of each series.

    A step maps new column names to SQL text in which ``{w}`` stands for "partition by key and
    chunk, order by position", or is a function of (rows, that window text); a later step may use
    the columns of an earlier one.

    ``position`` must be a dense row number within the key (on a gap-free hourly spine the hour
    number is one), so that "n rows back" and "n positions back" mean the same.
    """
    spread = spread_out(df, position, back, ahead, size or chunk_size(back, ahead))
    window = f"partition by {', '.join(keys)}, {CHUNK} order by {POSITION}"
    for step in steps:
        if callable(step):
            spread = step(spread, window)
        else:
            spread = spread.selectExpr("*", *[f"{text.format(w=window)} as {name}" for name, text in step.items()])
    return spread.where(f"{CHUNK} = {HOME}").drop(CHUNK, HOME, POSITION)


def over_chunk_tables(
    df: DataFrame, carried: DataFrame, keys: list[str], position: str, back: int, size: int,
    names: list[str], compute: Callable[[pa.Table, pa.Table], dict[str, np.ndarray]],
) -> DataFrame:
    """Add ``names``, doubles that ``compute`` finds for the rows of a (key, chunk) in order, and its row of ``carried``.

    What many window expressions of one order would do row by row, over ever wider rows, is done
    here column by column. A table holds a chunk and its border rows, never more. NaN is null in
    what ``compute`` returns. Rows without a key are left out, as by a join with ``carried``.
    """
    kept = list(df.columns)

    def chunk(rows: pa.Table, edges: pa.Table) -> pa.Table:
        rows = rows.sort_by(POSITION)
        found = compute(rows, edges)
        home = pc.equal(rows.column(CHUNK), rows.column(HOME))
        result = rows.select(kept)
        for name in names:
            result = result.append_column(name, pa.array(found[name], pa.float64(), from_pandas=True))
        return result.filter(home)

    spread = spread_out(df.where(" and ".join(f"{k} is not null" for k in keys)), position, back, 0, size)
    schema = StructType([*df.schema.fields, *[StructField(n, DoubleType()) for n in names]])
    return spread.groupBy(*keys, CHUNK).cogroup(carried.groupBy(*keys, CHUNK)).applyInArrow(chunk, schema)


def _time_chunk(period: str, hours: int) -> str:
    return f"floor(unix_seconds({period}) / {3600 * hours}) as {CHUNK}"


def with_ordinal(df: DataFrame, keys: list[str], period: str, hours: int = MIN_CHUNK, name: str = "ordinal") -> DataFrame:
    """Number the rows of each key from 0 in time order without one window per key.

    Rows are numbered inside time chunks; the count of earlier chunks (one small row per key and
    chunk) is added on top.
    """
    marked = df.selectExpr("*", _time_chunk(period, hours))
    listed = ", ".join(keys)
    offsets = marked.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("_rows")).selectExpr(
        *keys,
        CHUNK,
        f"coalesce(sum(_rows) over (partition by {listed} order by {CHUNK} "
        "rows between unbounded preceding and 1 preceding), 0) as _offset",
    )
    numbered = marked.selectExpr("*", f"row_number() over (partition by {listed}, {CHUNK} order by {period}) as _rn")
    return numbered.join(offsets.hint("merge"), [*keys, CHUNK]).selectExpr(*df.columns, f"_rn + _offset - 1 as {name}")


def with_previous(df: DataFrame, keys: list[str], period: str, value: str, name: str, hours: int = MIN_CHUNK) -> DataFrame:
    """The value one row earlier in each key, for series with gaps of any length.

    Inside a chunk this is ``lag``; the first row of a chunk takes the last value carried over
    from the closest earlier chunk that has rows.
    """
    marked = df.selectExpr("*", _time_chunk(period, hours))
    carried = (
        marked.groupBy(*keys, CHUNK)
        .agg(F.expr(f"max_by(struct({value} as v), {period})").alias("_last"))
        .select(*keys, CHUNK, F.lag("_last").over(W.partitionBy(*keys).orderBy(CHUNK)).alias("_carry"))
    )
    window = f"partition by {', '.join(keys)}, {CHUNK} order by {period}"
    return (
        marked.selectExpr("*", f"lag({value}) over ({window}) as _lag", f"row_number() over ({window}) as _rn")
        .join(carried.hint("merge"), [*keys, CHUNK])
        .selectExpr(*df.columns, f"case when _rn = 1 then _carry.v else _lag end as {name}")
    )
