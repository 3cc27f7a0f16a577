"""Landing, merging, watermarks, pull plans and the export."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattloom.catalogue.base import feeder_gold, register, view
from wattloom.operators.series import merge_weather, upsert_measures
from wattloom.schemas import BRONZE_MEASURES, LANDING_MEASURES, LANDING_WEATHER, WEATHER
from wattloom.session import shared_folder, written
from wattloom.sources import adapters, catalog, lake, landing, sinks


#: Events from so many consecutive numbers share a page, as a feed pages its records.
PAGE_RECORDS = 5000


def _pages(spark, sf_dir):
    """Events as downloaded pages: one nested JSON document per key, day and range of numbers, values as text.

    Signups report without a value, and error records carry an hour that does not parse.
    """
    events = adapters.event_measures(spark, sf_dir)
    hour = "date_format(period_utc, \"yyyy-MM-dd'T'HH\")"
    record = f"""struct(case when measure_code = 'XX' then 'soon' else {hour} end as period, ba_code as respondent,
                        measure_code as type, case when measure_code <> 'TI' then cast(value_mwh as string) end as value)"""
    pages = events.groupBy("ba_code", F.expr("to_date(period_utc)").alias("day"), F.expr(f"seq div {PAGE_RECORDS}").alias("page")).agg(
        F.expr(f"to_json(struct(struct(cast(count(*) as string) as total, collect_list({record}) as data) as response))").alias("body")
    )
    return pages.select("day", F.from_json("body", LANDING_MEASURES).alias("doc")).selectExpr("day", "doc.response")


@register(
    "normalised_pages",
    """SELECT period_utc, ba_code, measure_code, CASE WHEN measure_code <> 'TI' THEN value_mwh END AS value_mwh,
              TIMESTAMP '2024-02-01' AS ingested_at_utc
       FROM event_long WHERE measure_code <> 'XX'""",
)
def _normalised(spark, sf_dir):
    return landing.normalise_measures(_pages(spark, sf_dir), "timestamp'2024-02-01'")


@register(
    "flattened_weather",
    """SELECT period_utc, temperature_2m, relative_humidity_2m, dew_point_2m, CAST(NULL AS DOUBLE) AS apparent_temperature,
              cloud_cover, wind_speed_10m, shortwave_radiation, ba_code, source, TIMESTAMP '2023-03-01' AS ingested_at_utc
       FROM feed_weather_all""",
)
def _flattened(spark, sf_dir):
    """Weather records as column-oriented documents that lack one variable, flattened again."""
    sent = [c for c in WEATHER if c != "apparent_temperature"]
    arrays = ", ".join(f"transform(recs, x -> cast(x.{c} as string)) as {c}" for c in sent)
    time = "date_format(x.period_utc, \"yyyy-MM-dd'T'HH:mm\")"
    documents = (
        adapters.feeder_weather(spark, sf_dir)
        .groupBy(F.col("ba_code").alias("ba"), "source", F.expr("to_date(period_utc)").alias("day"))
        .agg(F.expr(f"collect_list(struct(period_utc, {', '.join(sent)}))").alias("recs"))
        .selectExpr("ba", "source", f"to_json(struct(struct(transform(recs, x -> {time}) as time, {arrays}) as hourly)) as body")
    )
    pages = documents.select("ba", "source", F.from_json("body", LANDING_WEATHER).alias("doc")).selectExpr("ba", "source", "doc.hourly")
    return landing.flatten_weather(pages, ingested_at="timestamp'2023-03-01'")


@register("upsert_measures", "SELECT period_utc, ba_code, measure_code, value_mwh, ingested_at_utc FROM event_latest")
def _upsert(spark, sf_dir):
    """The first half of the month is stored, a later download overlaps it."""
    events = adapters.event_measures(spark, sf_dir)
    stored = events.where("period_utc < timestamp'2024-01-16'")
    fresh = events.where("period_utc >= timestamp'2024-01-15'")
    return upsert_measures(stored, fresh, ["seq"]).drop("seq")


@register(
    "merge_weather",
    f"SELECT period_utc, ba_code, source, ingested_at_utc, {', '.join(WEATHER)} FROM feed_weather",
)
def _merge(spark, sf_dir):
    records = adapters.feeder_weather(spark, sf_dir)
    archive, forecast = records.where("source = 'era5_archive'"), records.where("source = 'forecast'")
    return merge_weather(archive, forecast, tiebreak=["arrival"]).drop("arrival")


register(
    "watermarks",
    "SELECT ba_code, max(period_utc) AS watermark_utc, strftime(max(period_utc), '%Y-%m-%dT%H') AS watermark FROM event_long GROUP BY 1",
)(lambda s, d: lake.watermarks(adapters.event_measures(s, d)))

view(
    "event_keys",
    "SELECT DISTINCT ba_code FROM event_long UNION SELECT 'TVA'",
)


@register(
    "pull_plan",
    """SELECT k.ba_code, coalesce(w.hi - INTERVAL 24 HOUR, TIMESTAMP '2019-01-01') AS start_utc,
              TIMESTAMP '2024-02-03 05:00:00' AS end_utc
       FROM event_keys k LEFT JOIN (SELECT ba_code, max(period_utc) AS hi FROM event_long GROUP BY 1) w USING (ba_code)""",
)
def _plan(spark, sf_dir):
    from wattloom.registry import authorities

    events = adapters.event_measures(spark, sf_dir)
    keys = authorities(spark, "PJM, ERCO, CISO, TVA")
    return lake.measure_plan(keys, lake.watermarks(events), "timestamp'2024-02-01 05:30:00'")


@register(
    "incremental_pull",
    """SELECT e.period_utc, e.ba_code, e.measure_code, e.value_mwh, e.ingested_at_utc, e.seq FROM event_long e
       JOIN (SELECT ba_code, max(period_utc) - INTERVAL 24 HOUR AS start_utc FROM event_long
             WHERE period_utc < TIMESTAMP '2024-01-20' GROUP BY 1) p USING (ba_code)
       WHERE e.period_utc >= p.start_utc AND e.period_utc <= TIMESTAMP '2024-02-03'""",
)
def _incremental(spark, sf_dir):
    events = adapters.event_measures(spark, sf_dir)
    marks = lake.watermarks(events.where("period_utc < timestamp'2024-01-20'"))
    plan = lake.measure_plan(marks, marks, "timestamp'2024-02-01'")
    return lake.within_plan(events, plan)


@register(
    "archive_plan",
    """SELECT ba_code, CAST(max(period_utc) AS DATE) - 1 AS start_date, DATE '2023-02-23' AS end_date,
              CAST(max(period_utc) AS DATE) - 1 <= DATE '2023-02-23' AS due
       FROM feed_weather_all WHERE source = 'era5_archive' GROUP BY 1""",
)
def _archive(spark, sf_dir):
    records = adapters.feeder_weather(spark, sf_dir)
    return lake.archive_plan(adapters.feeder_dimension(spark, sf_dir), records, "timestamp'2023-03-01'")


@register(
    "lake_round_trip",
    "SELECT period_utc, ba_code, measure_code, value_mwh, ingested_at_utc FROM event_latest",
)
def _round_trip(spark, sf_dir):
    """Merged measures written as partitions, and scanned back through the declared schema."""
    import uuid

    root = f"{shared_folder(spark)}/wattloom/{spark.sparkContext.applicationId}/lake-{uuid.uuid4().hex}"
    merged = upsert_measures(None, adapters.event_measures(spark, sf_dir), ["seq"])
    lake.write_partitions(merged.select(*BRONZE_MEASURES.fieldNames()), root, ["period_utc", "measure_code"])
    return lake.require_measures(spark, root)


_EXPORT_COLUMNS = ", ".join(sinks.EXPORT_FACT_COLUMNS)
register(
    "export_fact_window",
    f"""SELECT {_EXPORT_COLUMNS} FROM feed_fact
        WHERE period_utc >= (SELECT max(period_utc) FROM feed_fact) - INTERVAL 30 DAY""",
)(lambda s, d: sinks.export_tables({"fact_demand_hourly": written(feeder_gold(s, d)["fact_demand_hourly"], "fact")}, 30)["fact_demand_hourly"])


@register(
    "export_manifest",
    """SELECT 'app' AS database, CAST(NULL AS DOUBLE) AS size_mb, 30 AS window_days, table_name, rows,
              TIMESTAMP '2023-03-01' AS exported_at_utc
       FROM (SELECT 'dim_ba' AS table_name, count(*) AS rows FROM feed_dim
             UNION ALL SELECT 'dim_date', count(*) FROM feed_dates
             UNION ALL SELECT 'fact_demand_hourly', count(*) FROM feed_fact
                 WHERE period_utc >= (SELECT max(period_utc) FROM feed_fact) - INTERVAL 30 DAY
             UNION ALL SELECT 'fact_forecast_accuracy', count(*) FROM feed_accuracy
                 WHERE period_utc >= (SELECT max(period_utc) FROM feed_accuracy) - INTERVAL 30 DAY)""",
)
def _manifest(spark, sf_dir):
    from wattloom.plans.warehouse import build_accuracy

    gold = feeder_gold(spark, sf_dir)
    fact = written(gold["fact_demand_hourly"], "fact")
    held = {"dim_ba": gold["dim_ba"], "dim_date": gold["dim_date"], "fact_demand_hourly": fact, "fact_forecast_accuracy": build_accuracy(fact)}
    return sinks.manifest(sinks.export_tables(held, 30), "app", 30, "timestamp'2023-03-01'")


_NAMES = ["customer", "events", "lineitem", "nation", "orders", "part", "region", "supplier"]


@register("table_counts", " UNION ALL ".join(f"SELECT '{n}' AS \"table\", count(*) AS rows FROM {n}" for n in _NAMES))
def _counts(spark, sf_dir):
    catalog.register({f"given_{n}": adapters.table(spark, sf_dir, n) for n in _NAMES})
    counted = catalog.summarise(spark, [f"given_{n}" for n in _NAMES])
    return counted.selectExpr("substring(table, 7) as table", "rows")
