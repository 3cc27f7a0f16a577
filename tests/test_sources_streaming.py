import json
import uuid

import pytest
from pyspark.sql import functions as F

from wattloom.functions.scalars import hour_number
from wattloom.schemas import BRONZE_MEASURES, WEATHER, assert_columns
from wattloom.sources import catalog, lake, landing, sinks
from wattloom.streaming import flags, ingest, rollup


def test_landed_measure_pages(spark, tmp_path):
    data = [
        {"period": "2024-01-01T05", "respondent": "PJM", "type": "D", "value": "90123"},
        {"period": "2024-01-01T06", "respondent": "PJM", "type": "D"},
        {"period": "2024-01-01T07", "respondent": "PJM", "type": "D", "value": "n/a"},
        {"period": "yesterday", "respondent": "PJM", "type": "D", "value": "1"},
        {"period": "2024-01-01T08", "respondent": None, "type": "D", "value": "1"},
    ]
    (tmp_path / "p.json").write_text(json.dumps({"response": {"total": "5", "data": data}}, indent=1))
    rows = landing.normalise_measures(landing.read_measure_pages(spark, str(tmp_path)), "timestamp'2024-02-01'")
    assert_columns(rows, BRONZE_MEASURES, "bronze")
    assert [(r["period_utc"].hour, r["value_mwh"]) for r in rows.orderBy("period_utc").collect()] == [(5, 90123.0), (6, None), (7, None)]


def test_landed_weather_arrays(spark, tmp_path):
    folder = tmp_path / "ba=PJM" / "source=forecast"
    folder.mkdir(parents=True)
    body = {"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [3.1, None]}}
    (folder / "a.json").write_text(json.dumps(body))
    (folder / "b.json").write_text(json.dumps({"hourly": {"time": []}}))
    rows = landing.flatten_weather(landing.read_weather_pages(spark, str(tmp_path))).orderBy("period_utc").collect()
    assert [(r["ba_code"], r["source"], r["temperature_2m"], r["cloud_cover"]) for r in rows] == [("PJM", "forecast", 3.1, None), ("PJM", "forecast", None, None)]
    assert set(WEATHER) <= set(rows[0].asDict())


def reading(spark, key, hour, value, stamp):
    return spark.sql(
        f"select timestamp'2024-01-01' + interval {hour} hours as period_utc, '{key}' as ba_code, 'D' as measure_code, "
        f"{value}D as value_mwh, timestamp'2024-02-{stamp:02d}' as ingested_at_utc"
    )


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    root = str(tmp_path / "lake")
    assert lake.read_measures(spark, root).count() == 0 and lake.read_weather(spark, root) is None
    with pytest.raises(FileNotFoundError):
        lake.require_measures(spark, root)
    both = reading(spark, "PJM", 0, 1, 1).unionByName(reading(spark, "CISO", 0, 2, 1))
    counts = lake.write_partitions(both, root, ["period_utc"])
    assert {r["ba_code"]: r["rows"] for r in counts.collect()} == {"PJM": 1, "CISO": 1}
    lake.write_partitions(reading(spark, "PJM", 5, 9, 2), root, ["period_utc"])
    stored = {r["ba_code"]: r["value_mwh"] for r in lake.require_measures(spark, root).collect()}
    assert stored == {"PJM": 9.0, "CISO": 2.0}


def test_files_with_missing_columns_are_merged(spark, tmp_path):
    root = str(tmp_path / "lake")
    reading(spark, "PJM", 0, 1, 1).write.parquet(f"{root}/ba=PJM")
    reading(spark, "ERCO", 0, 1, 1).drop("value_mwh").select("measure_code", "ba_code", "period_utc", "ingested_at_utc").write.parquet(f"{root}/ba=ERCO")
    rows = lake.require_measures(spark, root)
    assert rows.columns == BRONZE_MEASURES.fieldNames() and rows.where("value_mwh is null").count() == 1


def test_pull_windows(spark):
    marks = lake.watermarks(reading(spark, "PJM", 30, 1, 1))
    assert marks.first()["watermark"] == "2024-01-02T06"
    keys = spark.createDataFrame([("PJM",), ("TVA",)], "ba_code string")
    plan = {r["ba_code"]: (str(r["start_utc"]), str(r["end_utc"])) for r in lake.measure_plan(keys, marks, "timestamp'2024-01-03 04:30:00'").collect()}
    assert plan == {"PJM": ("2024-01-01 06:00:00", "2024-01-05 04:00:00"), "TVA": ("2019-01-01 00:00:00", "2024-01-05 04:00:00")}
    early = lake.measure_plan(keys, marks, start_date="2010-01-01", full_refresh=True).first()
    assert str(early["start_utc"]) == "2015-07-01 00:00:00"
    weather = spark.sql("select 'PJM' as ba_code, 'era5_archive' as source, timestamp'2024-01-10 23:00:00' as period_utc union all select 'PJM', 'forecast', timestamp'2024-02-01'")
    due = {r["ba_code"]: (str(r["start_date"]), str(r["end_date"]), r["due"]) for r in lake.archive_plan(keys, weather, "timestamp'2024-01-14'").collect()}
    assert due == {"PJM": ("2024-01-09", "2024-01-08", False), "TVA": ("2019-01-01", "2024-01-08", True)}


def test_log_keeps_its_first_schema(spark, tmp_path):
    path = str(tmp_path / "log")
    sinks.append_log(spark.range(2), path, exists=False)
    sinks.append_log(spark.range(3), path, exists=True)
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(ValueError, match="holds"):
        sinks.append_log(spark.range(1).selectExpr("id as other"), path, exists=True)


def test_export_windows_and_manifest(spark, gold, tmp_path):
    tables = {k: gold[k] for k in ("dim_ba", "dim_date", "fact_demand_hourly", "fact_forecast_accuracy")}
    root = str(tmp_path / "app")
    listing = {r["table_name"]: r for r in sinks.export_app(tables, root, days=10).collect()}
    assert listing["fact_demand_hourly"]["rows"] == 3 * 241 and listing["dim_ba"]["rows"] == 3
    assert listing["dim_ba"]["size_mb"] > 0 and listing["dim_ba"]["database"] == "app"
    assert spark.read.json(f"{root}/_manifest").count() == 4
    assert spark.read.parquet(f"{root}/fact_demand_hourly").columns == sinks.EXPORT_FACT_COLUMNS
    short = {**tables, "fact_forecast_accuracy": gold["fact_forecast_accuracy"].where("period_utc < timestamp'2023-10-01'")}
    own = sinks.export_tables(short, 10)["fact_forecast_accuracy"].count()
    assert own > 0 and sinks.export_tables(short, 10, common_cutoff=True)["fact_forecast_accuracy"].count() == 0


def test_small_artifacts(spark, tmp_path):
    sinks.write_json(spark.range(3), str(tmp_path / "j"))
    sinks.write_csv(spark.range(3), str(tmp_path / "c"))
    assert spark.read.json(str(tmp_path / "j")).count() == 3
    assert len(list((tmp_path / "c").glob("*.csv"))) == 1 and spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["id"]


def test_catalog_questions(spark):
    catalog.register({"dim_date": spark.range(4), "model_scores": spark.range(2)})
    assert catalog.table_exists(spark, "dim_date") and catalog.row_count(spark, "dim_date") == 4 and catalog.row_count(spark, "nowhere") == 0
    assert {r["table"]: r["rows"] for r in catalog.summarise(spark, ["dim_date", "model_scores"]).collect()} == {"dim_date": 4, "model_scores": 2}
    assert "dim_date(id bigint)" in catalog.describe_schema(spark)
    assert catalog.describe_schema(spark, {"nowhere"}) == "(warehouse is empty)"
    assert catalog.drop_for_rebuild(spark) == ["model_scores"]
    assert not catalog.table_exists(spark, "dim_date")
    spark.catalog.dropTempView("model_scores")


# ------------------------------------------------------------------ streams


def test_late_corrections_win_and_reruns_change_nothing(spark, tmp_path):
    landing_folder, root, state = (str(tmp_path / n) for n in ("landing", "lake", "state"))
    reading(spark, "PJM", 0, 1, 1).unionByName(reading(spark, "PJM", 1, 2, 1)).write.parquet(f"{landing_folder}/a")
    run = lambda: ingest.ingest_stream(spark, f"{landing_folder}/*", root, state).awaitTermination()
    run()
    reading(spark, "PJM", 0, 10, 3).write.parquet(f"{landing_folder}/b")
    reading(spark, "PJM", 1, 7, 1).write.parquet(f"{landing_folder}/c")
    reading(spark, "ERCO", 900, 5, 1).write.parquet(f"{landing_folder}/d")
    run()
    run()
    rows = {(r["ba_code"], r["period_utc"].hour): r["value_mwh"] for r in lake.read_measures(spark, root).collect()}
    assert rows[("PJM", 0)] == 10.0 and len(rows) == 3


def test_rollup_drops_only_what_is_too_late(spark, tmp_path):
    folder = f"{tmp_path}/in"
    schema = "ba_code string, period_utc timestamp, demand_mwh double"

    def land(name, hour, value):
        spark.sql(f"select 'A' as ba_code, timestamp'2024-01-01' + interval {hour} hours as period_utc, {value}D as demand_mwh").write.parquet(f"{folder}/{name}")

    query_name = f"roll{uuid.uuid4().hex}"

    def run():
        stream = rollup.daily_rollup(spark.readStream.schema(schema).parquet(f"{folder}/*"))
        stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/{query_name}").outputMode("append").trigger(availableNow=True).start().awaitTermination()

    land("a", 1, 10)
    land("b", 30, 20)
    run()
    land("c", 2, 30)   # 28 hours behind: the day is still open
    run()
    land("d", 100, 1)
    run()
    land("e", 3, 99)   # its day is closed
    run()
    land("f", 200, 1)
    run()
    out = {str(r["date_utc"]): (r["hours_reported"], r["peak_demand_mw"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert out["2024-01-01"] == (2, 30.0) and out["2024-01-02"] == (1, 20.0)


SHORT = "ba_code string, period_utc timestamp, demand_mwh double"


def _batch_flags(df):
    w = "over (partition by ba_code order by period_utc)"
    return df.selectExpr(
        "ba_code", "period_utc", "demand_mwh",
        f"demand_mwh is not null and demand_mwh = lag(demand_mwh) {w} and demand_mwh = lag(demand_mwh, 2) {w} as flag_frozen_reading",
        f"abs(demand_mwh - lag(demand_mwh) {w}) / nullif(lag(demand_mwh) {w}, 0D) * 100 > 40 as flag_extreme_ramp",
    )


def _run_flags(spark, folder, out, state):
    stream = flags.flag_on_arrival(spark.readStream.schema(SHORT).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*"))
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()


def test_flags_of_out_of_order_batches_equal_the_batch_flags(spark, tmp_path):
    values = [5.0, 5.0, 5.0, None, 5.0, 5.0, 9.0, 0.0, 3.0, 3.0, 3.0, 3.0] * 8
    rows = [(k, i, (v if k == "A" else 7.0)) for k in "AB" for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "ba_code string, i int, demand_mwh double").selectExpr(
        "ba_code", "timestamp'2024-01-01' + make_interval(0,0,0,0,i,0,0) as period_utc", "demand_mwh", "i"
    )
    folder = f"{tmp_path}/in"
    for landing in range(5):  # a reading lands up to 20 hours late, in a file of its own batch, the newest first
        df.where(f"floor((i + pmod(xxhash64(ba_code, i), 21)) / 25) = {landing}").orderBy(F.desc("i")).drop("i").coalesce(1).write.parquet(f"{folder}/{landing}")
    for nth in (1, 2):
        spark.sql(f"select explode(array('A', 'B')) as ba_code, timestamp'2030-01-0{nth}' as period_utc, 1D as demand_mwh").coalesce(1).write.parquet(f"{folder}/end{nth}")
    _run_flags(spark, folder, f"{tmp_path}/out", f"{tmp_path}/state")
    want = _batch_flags(df)
    got = spark.read.parquet(f"{tmp_path}/out").where("period_utc < timestamp'2030-01-01'").select(*want.columns)
    assert got.orderBy("ba_code", "period_utc").collect() == want.orderBy("ba_code", "period_utc").collect()


def test_too_late_readings_are_dropped_and_runs_go_on(spark, tmp_path):
    def land(name, hour, value):
        spark.sql(f"select 'A' as ba_code, timestamp'2024-01-01' + interval {hour} hours as period_utc, {value}D as demand_mwh").coalesce(1).write.parquet(f"{tmp_path}/in/{name}")

    for name, hour, value in (("a", 0, 10), ("b", 100, 10), ("c", 101, 20)):
        land(name, hour, value)
    _run_flags(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state")
    land("d", 1, 99)  # its hour has been passed
    land("e", 200, 20)
    land("f", 300, 1)
    _run_flags(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state")
    got = spark.read.parquet(f"{tmp_path}/out").orderBy("period_utc").collect()
    assert [(r["demand_mwh"], r["flag_extreme_ramp"]) for r in got][:3] == [(10.0, None), (10.0, False), (20.0, True)]
    assert 99.0 not in [r["demand_mwh"] for r in got]


def test_state_written_follows_the_batch_not_the_waiting_readings(spark, tmp_path):
    def land(name, rows):
        rows.selectExpr("ba_code", "timestamp'2024-01-01' + make_interval(0,0,0,0,0,i,0) as period_utc", "1D as demand_mwh").coalesce(1).write.parquet(f"{tmp_path}/in/{name}")

    land("a", spark.range(600).selectExpr("'A' as ba_code", "cast(id as int) as i"))
    land("b", spark.sql("select 'A' as ba_code, 700 as i"))  # ten minutes on: all still wait
    stream = flags.flag_on_arrival(spark.readStream.schema(SHORT).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*"))
    query = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    written = [p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress if p["numInputRows"]]
    assert written[0] >= 600 and 0 < written[1] < 10
    assert spark.read.parquet(f"{tmp_path}/out").count() == 0


def test_merge_reads_touched_folders_only(spark, tmp_path):
    """The scan's file count is that of the folders a batch touches; new folders and many of them work, too."""
    from wattloom.streaming import ingest

    rows = spark.range(24 * 200).selectExpr(
        "timestamp_seconds(unix_seconds(timestamp'2024-01-01') + id * 3600) as period_utc", "concat('B', id % 4) as ba_code", "'D' as measure_code",
        "cast(id as double) as value_mwh", "timestamp'2024-09-01' as ingested_at_utc",
    )
    root, staging = str(tmp_path / "lake"), str(tmp_path / "staging")
    ingest.merge_batch(rows, root, staging, 0)
    fresh = rows.where("ba_code = 'B1' and period_utc between timestamp'2024-03-05' and timestamp'2024-04-02'").selectExpr(
        "period_utc", "ba_code", "measure_code", "-value_mwh as value_mwh", "timestamp'2024-09-02' as ingested_at_utc"
    )
    touched = fresh.selectExpr("ba_code as ba", "date_format(period_utc, 'yyyy-MM') as month").distinct()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        read = ingest.touched_partitions(spark, root, touched)
        plan = read._jdf.queryExecution().executedPlan()
        assert read._jdf.collectAsList().size() == 31 * 6 + 30 * 6
        leaf = plan.collectLeaves().head()
        assert leaf.metrics().apply("numFiles").value() == 2 and leaf.metrics().apply("numPartitions").value() == 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    ingest.merge_batch(fresh, root, staging, 1)
    merged = spark.read.parquet(root)
    assert merged.count() == rows.count() and merged.where("value_mwh < 0").count() == fresh.count()
