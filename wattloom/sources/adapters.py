"""The given benchmark tables in the shape of the grid lake.

Every line item is one telemetry record of a feeder (twenty suppliers form one feeder) and one
weather record of its load centre; a ship day is one hour of the series. Feeders, records and
work therefore grow with the tables. The same records laid over a civil year (a ship day is four hours
there) make a feed that crosses every season and both changes of the clocks. Events are another, sparse
feed for three authorities with duplicates, late corrections and an unknown measure code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.schemas import ARCHIVE_SOURCE, FORECAST_SOURCE
from wattloom.session import configure, dealt_out

SERIES_START = "2022-11-07 00:00:00"
FIRST_SHIP_DAY = "1995-01-01"
#: The civil feed begins here and spends so many hours a ship day; an order's number says which of them.
CIVIL_START = "2023-02-01 00:00:00"
CIVIL_HOURS = 4
SUPPLIERS_PER_FEEDER = 20
#: So many records go to a task where they are dealt by hour.
RECORDS_A_TASK = 500_000
ZONES = ("America/New_York", "America/Chicago", "America/Los_Angeles", "America/Denver")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _to(value: str, step: int) -> str:
    """Rounded to a tenth (10) or hundredth (100)."""
    return f"floor(({value}) * {step} + 0.5D) / {step}"


def feeder(suppkey: str) -> str:
    return f"floor({suppkey} / {SUPPLIERS_PER_FEEDER})"


def feeder_code(number: str) -> str:
    digits = f"cast({number} as string)"
    return f"concat('BA', lpad({digits}, greatest(6, length({digits})), '0'))"


def _lines(spark: SparkSession, sf_dir: str, civil: bool = False, by_hour: bool = False) -> DataFrame:
    """Line items with their feeder, hour of the series and order of arrival.

    ``by_hour`` deals them by feeder and hour, a bounded number to a task: the merges then meet all records of an
    hour where they are. Few hours come twice in a task's piece of the table, so a merge before the shuffle would
    only hold nearly all of the piece, at the width of its buffers, and spill it.
    """
    step = f"datediff(to_date(l_shipdate), date'{FIRST_SHIP_DAY}')"
    start, hour = (CIVIL_START, f"({step} * {CIVIL_HOURS} + pmod(l_orderkey, {CIVIL_HOURS}))") if civil else (SERIES_START, step)
    needed = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_discount l_tax l_returnflag l_linestatus l_shipdate"
    items = table(spark, sf_dir, "lineitem").select(*needed.split())
    lines = (items if by_hour else dealt_out(items, "l_orderkey")).selectExpr(
        "*",
        f"{feeder('l_suppkey')} as g",
        f"{feeder_code(feeder('l_suppkey'))} as ba_code",
        f"{step} % 24 as h",
        f"timestamp_seconds(unix_seconds(timestamp'{start}') + {hour} * 3600) as period_utc",
        "cast(l_shipdate as timestamp) as ingested_at_utc",
        # Order and line, and the part for records that share both: which of several records of an
        # hour came last, up to 10 ** 15 parts. One number, so that the merges hash.
        "cast(cast(l_orderkey * 8 + l_linenumber as decimal(19, 0)) * 1000000000000000BD + l_partkey as decimal(34, 0)) as arrival",
    )
    if not by_hour:
        return lines
    tasks = max(spark.sparkContext.defaultParallelism, -(-items.count() // RECORDS_A_TASK))
    return lines.repartition(tasks, "ba_code", "period_utc")


def feeder_measures(spark: SparkSession, sf_dir: str, civil: bool = False, by_hour: bool = False) -> DataFrame:
    """Bronze measures: four readings per line item, with meter faults and unreported values."""
    lines = _lines(spark, sf_dir, civil, by_hour).selectExpr(
        "*",
        """1000D * (1 + g % 5)
           * case when h < 6 then 0.9D else 1.18D - abs(h - 15) * 0.02D end
           * (1 + floor(l_quantity / 10) * 0.02D) as plain""",
        """case when l_linenumber = 7 and l_quantity >= 49 then 10D
                when l_linenumber = 6 and l_quantity <= 1 then 0D
                when l_linenumber = 5 and l_tax = 0.08D and l_quantity > 40 then 1.4D
                else 1D end as fault""",
    )
    return lines.selectExpr(
        "period_utc", "ba_code", "ingested_at_utc", "arrival",
        f"""stack(4,
            'D', case when not (l_linenumber = 4 and l_quantity >= 40) then {_to('plain * fault', 10)} end,
            'DF', case when not (l_returnflag = 'N' and l_discount = 0)
                       then {_to('plain * (0.96D + 0.8D * l_discount)', 10)} end,
            'NG', {_to('plain * 1.03D', 10)},
            'TI', {_to('plain * (l_tax - 0.04D)', 10)}) as (measure_code, value_mwh)""",
    ).select("period_utc", "ba_code", "measure_code", "value_mwh", "ingested_at_utc", "arrival")


def feeder_weather(spark: SparkSession, sf_dir: str, civil: bool = False, by_hour: bool = False) -> DataFrame:
    """Bronze weather: one record per line item, archive or forecast by line status."""
    return (
        _lines(spark, sf_dir, civil, by_hour)
        .selectExpr(
            "*",
            "(l_linenumber = 3 and l_quantity >= 45) as absent",
            f"""case when l_linenumber = 2 and l_quantity >= 50 and l_tax = 0.08D then 99D
                     when not (l_linenumber = 3 and l_quantity >= 45)
                     then {_to('14 + (l_quantity - 25.5D) * 0.4D + (6 - abs(h - 14)) * 0.5D', 100)} end as temp""",
        )
        .selectExpr(
            "period_utc",
            "temp as temperature_2m",
            f"case when not absent then {_to('50 + l_discount * 300', 10)} end as relative_humidity_2m",
            f"{_to('temp - 5', 100)} as dew_point_2m",
            f"{_to('temp - l_tax * 20', 100)} as apparent_temperature",
            "l_quantity * 2 as cloud_cover",
            f"case when l_linenumber <> 1 then {_to('l_tax * 100', 10)} end as wind_speed_10m",
            "greatest(0D, 600D - 50D * abs(h - 12)) as shortwave_radiation",
            "ba_code",
            f"case when l_linestatus = 'F' then '{ARCHIVE_SOURCE}' else '{FORECAST_SOURCE}' end as source",
            "ingested_at_utc", "arrival",
        )
    )


def feeder_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dim_ba`` rows of the feeders, from suppliers and their nations."""
    zones = ", ".join(f"'{z}'" for z in ZONES)
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey")
    )
    return (
        table(spark, sf_dir, "supplier")
        .join(nations, F.expr("s_nationkey = n_nationkey"))
        .groupBy(F.expr(feeder("s_suppkey")).alias("g"))
        .agg(F.min("s_name").alias("ba_name"), F.min("r_name").alias("region"), F.min("n_name").alias("load_centre"))
        .selectExpr(
            f"{feeder_code('g')} as ba_code",
            "ba_name",
            f"get(array({zones}), cast(g % {len(ZONES)} as int)) as timezone",
            "region",
            "load_centre",
            "25D + g % 20 as latitude",
            "-120D + g % 50 as longitude",
        )
    )


def event_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze measures from events: three authorities, one reading per event."""
    return dealt_out(table(spark, sf_dir, "events").drop("props"), "event_id").selectExpr(
        "timestamp_seconds(floor(unix_seconds(cast(ts as timestamp)) / 3600) * 3600) as period_utc",
        "get(array('PJM', 'ERCO', 'CISO'), cast(user_id % 3 as int)) as ba_code",
        """case event_type when 'view' then 'D' when 'click' then 'DF' when 'purchase' then 'NG'
                           when 'signup' then 'TI' else 'XX' end as measure_code""",
        "value as value_mwh",
        "cast(ts as timestamp) as ingested_at_utc",
        "event_id as seq",
    )
