"""Channel scaling and sliding training windows as array columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.operators.chunking import CHUNK, chunk_size, with_ordinal
from wattloom.operators.quantiles import grouped_quantiles
from wattloom.schemas import HORIZON, LOOKBACK
from wattloom.session import written

# Channels of the past and of the known future, and strides.
FUTURE_CHANNELS = [
    "temperature_2m", "apparent_temperature", "relative_humidity_2m", "cloud_cover", "wind_speed_10m",
    "heating_degrees", "cooling_degrees", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "doy_sin", "doy_cos",
    "is_business_day", "is_holiday",
]
PAST_CHANNELS = ["demand_mwh", *FUTURE_CHANNELS]
ENCODER_STRIDE = 3
TRAIN_STRIDE = 12
TEST_STRIDE = 6
#: So many rows go to a task that packs them into windows.
ROWS_A_TASK = 200_000


def channel_stats(frame: DataFrame, channels: list[str]) -> DataFrame:
    """(channel, mean, std): population figures ignoring NULLs; a flat channel scales by one."""
    stats = frame.agg(
        *[F.expr(f"avg({c})").alias(f"m_{c}") for c in channels],
        *[F.expr(f"stddev_pop({c})").alias(f"s_{c}") for c in channels],
    )
    pairs = ", ".join(f"'{c}', cast(m_{c} as double), cast(s_{c} as double)" for c in channels)
    return stats.selectExpr(f"stack({len(channels)}, {pairs}) as (channel, mean, std)").selectExpr(
        "channel", "mean", "case when std < 1e-6D then 1D else std end as std"
    )


def standardise(frame: DataFrame, stats: DataFrame, channels: list[str]) -> DataFrame:
    """Channels minus mean over deviation; a missing value becomes 0.

    The statistics are one row per channel, read through a one-row map.
    """
    lookup = stats.agg(F.expr("map_from_entries(collect_list(struct(channel, struct(mean, std))))").alias("m")).scalar()
    marked = frame.withColumn("_stats", lookup)
    scaled = {c: f"coalesce(({c} - _stats['{c}'].mean) / _stats['{c}'].std, 0D)" for c in channels}
    return marked.selectExpr(*[f"{scaled[c]} as {c}" if c in scaled else c for c in frame.columns])


def target_stats(frame: DataFrame, target: str = "demand_mwh") -> DataFrame:
    """Robust centre and spread per key: median and IQR / 1.349, with a floor for flat series."""
    q = grouped_quantiles(frame, ["ba_code"], target, {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    return q.selectExpr(
        "ba_code",
        "q2 as centre",
        "case when (q3 - q1) / 1.349D > 0 then (q3 - q1) / 1.349D else greatest(q2 * 0.1D, 1D) end as spread",
    )


def global_stats(frame: DataFrame, target: str = "demand_mwh") -> DataFrame:
    q = grouped_quantiles(frame, [], target, {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    return q.selectExpr(
        "q2 as centre", "case when (q3 - q1) / 1.349D > 0 then (q3 - q1) / 1.349D else 1D end as spread"
    )


def with_target_stats(frame: DataFrame, stats: DataFrame, overall: DataFrame) -> DataFrame:
    """Attach ``_centre`` and ``_spread`` of the key; a key without statistics uses the global ones."""
    fallback = overall.select(F.struct("centre", "spread")).scalar()
    known = stats.selectExpr("ba_code", "centre as _c", "spread as _s")
    return frame.join(known, "ba_code", "left").withColumn("_global", fallback).selectExpr(
        *frame.columns, "coalesce(_c, _global.centre) as _centre", "coalesce(_s, _global.spread) as _spread"
    )


def scale_target(frame: DataFrame, stats: DataFrame, overall: DataFrame, target: str = "demand_mwh", name: str = "target_z") -> DataFrame:
    return with_target_stats(frame, stats, overall).selectExpr(*frame.columns, f"({target} - _centre) / _spread as {name}")


def unscale(frame: DataFrame, stats: DataFrame, overall: DataFrame, columns: list[str]) -> DataFrame:
    """Scaled predictions back to physical units."""
    rows = with_target_stats(frame, stats, overall)
    return rows.selectExpr(*[f"{c} * _spread + _centre as {c}" if c in columns else c for c in frame.columns])


def sliding_windows(
    frame: DataFrame,
    valid_start: str,
    test_start: str,
    lookback: int = LOOKBACK,
    horizon: int = HORIZON,
    past: list[str] | None = None,
    future: list[str] | None = None,
    target: str = "target_z",
    train_stride: int = TRAIN_STRIDE,
    test_stride: int = TEST_STRIDE,
    require_contiguous: bool = False,
) -> DataFrame:
    """Training windows: every third past hour, the known future, and the target hours.

    A window is positioned by the row its forecast starts at and belongs to the split of that
    hour; it exists only with all ``lookback + horizon`` rows. Each (key, chunk of rows) is packed
    once into one sorted array, with the border rows its windows reach borrowed from the chunks
    beside it, and the windows are slices of that array: a row is shuffled once, or twice near a
    border, however many windows hold it. ``require_contiguous`` drops windows that span a gap in time.
    A task packs a bounded number of rows. ``frame`` is read several times: pass a written table.
    """
    past, future = past or PAST_CHANNELS, future or FUTURE_CHANNELS
    strides = {"train": train_stride, "valid": train_stride, "test": test_stride}
    split = f"case when period_utc < {valid_start} then 'train' when period_utc < {test_start} then 'valid' else 'test' end"
    rows = with_ordinal(frame, ["ba_code"], "period_utc").selectExpr("*", f"{split} as _split")

    spans = rows.groupBy("ba_code").agg(
        F.max("ordinal").alias("_last"),
        *[
            F.expr(f"{side}(case when _split = '{s}' and ordinal >= {lookback} then ordinal end)").alias(f"_{side}_{s}")
            for s in strides
            for side in ("min", "max")
        ],
    )

    spans = written(spans, "window_spans")  # a row a key: the packed rows are not sorted for a table that can be broadcast
    size = chunk_size(lookback, horizon)
    tasks = max(frame.sparkSession.sparkContext.defaultParallelism, -(-frame.count() // ROWS_A_TASK))

    def starts(s: str, stride: int) -> str:
        low = f"_min_{s} + cast(ceil((greatest(_min_{s}, {CHUNK} * {size}) - _min_{s}) / {stride}) as bigint) * {stride}"
        high = f"least(_max_{s}, _last - {horizon - 1}, ({CHUNK} + 1) * {size} - 1)"
        return f"""case when _min_{s} is not null and {low} <= {high}
            then transform(sequence({low}, {high}, {stride}L), o -> struct('{s}' as split, o as first))
            else array() end"""

    def vector(columns: list[str]) -> str:
        return f"array({', '.join(f'cast({c} as float)' for c in columns)})"

    packed = (
        rows.selectExpr(
            "ba_code", f"struct(ordinal, period_utc as at, {vector(past)} as past, {vector(future)} as future, cast({target} as float) as target) as _row",
            f"explode(sequence(greatest(ordinal - {horizon - 1}, 0L) div {size}, (ordinal + {lookback}) div {size})) as {CHUNK}",
        )
        .repartition(tasks, "ba_code", CHUNK)
        .groupBy("ba_code", CHUNK)
        .agg(F.expr("sort_array(collect_list(_row))").alias("_rows"))
        .join(spans, "ba_code")
    )

    def at(place: str) -> str:
        return f"_rows[cast({place} - _rows[0].ordinal as int)]"

    ahead = f"slice(_rows, cast(w.first - _rows[0].ordinal as int) + 1, {horizon})"
    gathered = packed.selectExpr(
        "ba_code",
        f"""inline(transform(concat({', '.join(starts(s, n) for s, n in strides.items())}), w -> named_struct(
            'split', w.split, 'first', w.first, 'horizon_start', {at('w.first')}.at,
            'past', transform(sequence(w.first - {lookback}, w.first - 1, {ENCODER_STRIDE}L), o -> {at('o')}.past),
            'future', transform({ahead}, r -> r.future), 'target', transform({ahead}, r -> r.target),
            '_begin', {at(f'w.first - {lookback}')}.at, '_end', {at(f'w.first + {horizon - 1}')}.at)))""",
    )
    if require_contiguous:
        gathered = gathered.where(f"unix_seconds(_end) - unix_seconds(_begin) = {(lookback + horizon - 1) * 3600}")
    return gathered.selectExpr(
        "ba_code", "split", f"first - {lookback} as start", "horizon_start", "past", "future", "target"
    )
