"""Long-to-wide pivot, latest-wins merge, hourly spine and gap interpolation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.functions.scalars import hour_number
from wattloom.operators.chunking import CHUNK, MIN_CHUNK, POSITION, Step, over_chunks
from wattloom.schemas import ARCHIVE_SOURCE, MEASURES, WEATHER

MEASURE_KEY = ["ba_code", "period_utc", "measure_code"]


#: Values of the types an order key is packed from: how many there are, and what makes the least of them 0.
_MICROS = 62_135_596_800_000_000  # from the year 1 to 1970; six times as many reach beyond the year 9999
_LONG = 1 << 63
_PACKED = {
    "boolean": (2, "cast({} as int)"),
    "tinyint": (1 << 8, "{} + 128"),
    "smallint": (1 << 16, "{} + 32768"),
    "int": (1 << 32, "{} + 2147483648"),
    "date": (1 << 32, "unix_date({}) + 2147483648"),
    "timestamp": (6 * _MICROS, f"unix_micros({{}}) + {_MICROS}"),
    "bigint": (2 * _LONG, f"cast({{}} as decimal(19, 0)) + {_LONG}BD"),
}
_FIXED_WIDTH = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "decimal")


def _fields(kind: T.DataType, text: str) -> list[tuple[T.DataType, str]]:
    if isinstance(kind, T.StructType):
        return [leaf for f in kind.fields for leaf in _fields(f.dataType, f"{text}.{f.name}")]
    return [(kind, text)]


def order_key(df: DataFrame, order: str) -> str:
    """SQL text of one decimal that sorts as the struct ``order`` does, nulls first; any other ``order`` stays as it is.

    An aggregate whose buffers are all of fixed width hashes; with a struct among them it would sort
    every row first. A struct that has other parts, or more values than 38 digits, stays a struct.
    """
    kind = df.selectExpr(f"{order} as o").schema["o"].dataType
    if not isinstance(kind, T.StructType):
        return order
    digits, values = "0BD", 1
    for part, text in _fields(kind, f"({order})"):
        whole = isinstance(part, T.DecimalType) and part.scale == 0
        if not whole and part.simpleString() not in _PACKED:
            return order
        many, shift = (2 * 10**part.precision, f"{{}} + {10**part.precision}BD") if whole else _PACKED[part.simpleString()]
        values *= many + 1
        digits = f"cast(({digits}) * {many + 1}BD + coalesce(cast({shift.format(text)} + 1 as decimal(38, 0)), 0BD) as decimal(38, 0))"
    return digits if values < 10**38 else order


def latest_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep, per key, the whole row that is last in ``order``.

    An aggregate rather than a ranking window: duplicates collapse before the shuffle, so a key
    with very many copies costs one row per input task. Rows of fixed-width columns collapse in a
    hash table; a row with a string or a nested column is one struct, and is sorted.
    """
    rest = [f.name for f in df.schema if f.name not in keys]
    rank = order_key(df, f"struct({', '.join(f'{o} as o{i}' for i, o in enumerate(order))})")
    if not rank.startswith("struct(") and all(df.schema[c].dataType.simpleString().split("(")[0] in _FIXED_WIDTH for c in rest):
        ranked = df.selectExpr("*", f"{rank} as _rank")
        picked = ranked.groupBy(*keys).agg(*[F.expr(f"max_by({c}, _rank)").alias(c) for c in rest])  # all see the same rows in the same order
        return picked.select(*df.columns)
    picked = df.groupBy(*keys).agg(F.expr(f"max_by(struct({', '.join(rest)}), {rank})").alias("_row"))
    return picked.selectExpr(*[c if c in keys else f"_row.{c} as {c}" for c in df.columns])


def upsert_measures(existing: DataFrame | None, fresh: DataFrame, tiebreak: list[str] | None = None) -> DataFrame:
    """Merge a download into stored rows; the newest download of a reading wins.

    Readings of one download carry one stamp; ``tiebreak`` columns settle which of them is last.
    """
    both = fresh if existing is None else existing.unionByName(fresh, allowMissingColumns=True)
    return latest_wins(both, MEASURE_KEY, ["ingested_at_utc", *(tiebreak or [])])


def merge_weather(*frames: DataFrame, tiebreak: list[str] | None = None) -> DataFrame:
    """Merge weather sources: the archive beats the forecast, then the newer download."""
    both = frames[0]
    for frame in frames[1:]:
        both = both.unionByName(frame, allowMissingColumns=True)
    order = [f"(source = '{ARCHIVE_SOURCE}')", "ingested_at_utc", *(tiebreak or [])]
    return latest_wins(both, ["ba_code", "period_utc"], order)


def pivot_measures(bronze: DataFrame) -> DataFrame:
    """One row per (ba, period), one column per known measure."""
    return bronze.groupBy("ba_code", "period_utc").agg(
        *[F.expr(f"max(case when measure_code = '{code}' then value_mwh end)").alias(c) for code, c in MEASURES.items()]
    )


def pivot_latest(bronze: DataFrame, arrival: str) -> DataFrame:
    """``pivot_measures(upsert_measures(...))`` in a single aggregation and a single shuffle.

    ``arrival`` grows with each download: a number, a timestamp, or a struct of several. Copies
    collapse before the shuffle, and unused measures are pruned.
    """

    ranked = bronze.selectExpr("ba_code", "period_utc", "measure_code", "value_mwh", f"{order_key(bronze, arrival)} as _rank")
    return ranked.groupBy("ba_code", "period_utc").agg(
        *[F.expr(f"max_by(value_mwh, case when measure_code = '{code}' then _rank end)").alias(c) for code, c in MEASURES.items()]
    )


def weather_latest(records: DataFrame, arrival: str, columns: list[str] | tuple[str, ...] = WEATHER) -> DataFrame:
    """Weather variables of the preferred record of each hour, in one prunable aggregation.

    ``arrival`` already puts the archive above the forecast.
    """
    ranked = records.selectExpr("ba_code", "period_utc", *columns, f"{order_key(records, arrival)} as _rank")
    return ranked.groupBy("ba_code", "period_utc").agg(*[F.expr(f"max_by({c}, _rank)").alias(c) for c in columns])


def series_bounds(df: DataFrame) -> DataFrame:
    """First and last period of each key: two columns scanned, one small row per key shuffled."""
    return df.groupBy("ba_code").agg(F.min("period_utc").alias("lo"), F.max("period_utc").alias("hi"))


def hourly_spine(bounds: DataFrame) -> DataFrame:
    """Every hour of each key from its own first to its own last.

    Keys are first cut into spans of ``MIN_CHUNK`` hours and spread over the cluster, so that a
    few very long keys do not generate their hours in a few tasks.
    """
    tasks = max(bounds.sparkSession.sparkContext.defaultParallelism, 1)
    spans = (
        bounds.selectExpr("ba_code", f"{hour_number('lo')} as _lo", f"{hour_number('hi')} as _hi")
        .selectExpr("ba_code", "_hi", f"explode(sequence(_lo, _hi, {MIN_CHUNK}L)) as _from")
        .repartition(tasks, "ba_code", "_from")
    )
    return spans.selectExpr(
        "ba_code", f"explode(sequence(_from, least(_from + {MIN_CHUNK - 1}, _hi))) as _hour"
    ).selectExpr("ba_code", "timestamp_seconds(_hour * 3600) as period_utc")


def carried_values(df: DataFrame, keys: list[str], position: str, columns: list[str], size: int) -> DataFrame:
    """One row per (key, chunk): the closest known values before and after the chunk (``_in`` and ``_out``), and their positions."""
    listed = ", ".join(keys)
    marked = df.selectExpr(*keys, *columns, f"cast({position} as bigint) as _p", f"floor({position} / {size}) as {CHUNK}")
    edges = marked.groupBy(*keys, CHUNK).agg(
        *[
            F.expr(text).alias(f"_{side}{part}_{c}")
            for c in columns
            for side in ("min", "max")
            for part, text in (
                ("p", f"{side}(case when {c} is not null then _p end)"),
                ("v", f"{side}_by({c}, case when {c} is not null then _p end)"),
            )
        ]
    )

    # "Up to the row before" in either direction: a frame that runs to the end of its partition
    # would be summed up anew for every row.
    before = "rows between unbounded preceding and 1 preceding"
    earlier = f"partition by {listed} order by {CHUNK} {before}"
    later = f"partition by {listed} order by {CHUNK} desc {before}"
    return edges.selectExpr(
        *keys,
        CHUNK,
        *[f"last(_max{part}_{c}, true) over ({earlier}) as _in{part}_{c}" for c in columns for part in "pv"],
        *[f"last(_min{part}_{c}, true) over ({later}) as _out{part}_{c}" for c in columns for part in "pv"],
    )


def fill_gaps_step(df: DataFrame, keys: list[str], position: str, columns: list[str], limit: int, size: int) -> Step:
    """Linear gap filling as a step of ``over_chunks`` run with the same ``position`` and ``size``.

    Neighbouring values inside a chunk come from windows; values beyond the chunk are carried in
    from one summary row per (key, chunk), so a gap may be longer than any chunk.
    """
    carried = carried_values(df, keys, position, columns, size)

    def nearest(c: str, part: str, window: str, carry: str) -> str:
        seen = c if part == "v" else f"case when {c} is not null then {POSITION} end"
        return f"coalesce(last({seen}, true) over ({window} rows between unbounded preceding and current row), _{carry}{part}_{c})"

    def filled(c: str) -> str:
        p, bp, bv, ap, av = POSITION, f"_bp_{c}", f"_bv_{c}", f"_ap_{c}", f"_av_{c}"
        return f"""case when {c} is not null then {c}
            when {bp} is not null and {ap} is not null and least({p} - {bp}, {ap} - {p}) <= {limit}
                then {bv} + ({av} - {bv}) * ({p} - {bp}) / ({ap} - {bp})
            when {ap} is null and {p} - {bp} <= {limit} then {bv}
            when {bp} is null and {ap} - {p} <= {limit} then {av} end as {c}"""

    def step(rows: DataFrame, window: str) -> DataFrame:
        names = rows.columns
        after = [f"_a{part}_{c}" for c in columns for part in "pv"]
        near = (
            rows.join(carried.hint("merge"), [*keys, CHUNK])
            .selectExpr("*", *[f"{nearest(c, part, window + ' desc', 'out')} as _a{part}_{c}" for c in columns for part in "pv"])
            .selectExpr(
                *names, *after, *[f"{nearest(c, part, window, 'in')} as _b{part}_{c}" for c in columns for part in "pv"]
            )
        )
        kept = [c for c in names if c not in columns]
        return near.selectExpr(*kept, *[filled(c) for c in columns])

    return step


def interpolate_gaps(
    df: DataFrame, keys: list[str], position: str, columns: list[str], limit: int = 6, size: int = MIN_CHUNK
) -> DataFrame:
    """Fill gaps linearly, at most ``limit`` rows from either side; ends take the nearest value."""
    step = fill_gaps_step(df, keys, position, columns, limit, size)
    return over_chunks(df, keys, position, 0, 0, step, size=size).select(*df.columns)
