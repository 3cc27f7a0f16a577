"""Registration, shared Spark frames and the shared SQL definitions of the same frames."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from wattloom.functions.scalars import without_zone
from wattloom.operators.series import pivot_latest, weather_latest
from wattloom.plans.warehouse import build_accuracy, build_gold
from wattloom.schemas import ARCHIVE_SOURCE
from wattloom.session import configure, remembered, written
from wattloom.sources import adapters

#: Events are delivered in order of arrival, then of their number.
EVENT_ARRIVAL = "struct(ingested_at_utc, seq)"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
#: The texts as registered, without the shared steps before them.
BODIES: dict[str, str] = {}
VIEWS: dict[str, str] = {}


def view(name: str, body: str) -> None:
    """Define a named SQL step that the texts of several queries share."""
    VIEWS[name] = body.strip()


def with_views(body: str) -> str:
    """Prefix ``body`` with the shared steps it mentions, in dependency order."""
    order: list[str] = []

    def visit(text: str, stack: tuple[str, ...]) -> None:
        for name in VIEWS:
            if name not in stack and re.search(rf"\b{name}\b", text):
                visit(VIEWS[name], (*stack, name))
                if name not in order:
                    order.append(name)

    visit(body, ())
    if not order:
        return body.strip()
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED (\n{VIEWS[n]}\n)" for n in order) + "\n" + body.strip()


def register(name: str, sql: str | None = None):
    """Register a query; UTC instants leave as plain timestamps so every reader agrees on them."""

    def wrap(function: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return without_zone(function(configure(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            BODIES[name], SQL[name] = sql, with_views(sql)
        return function

    return wrap


def feeder_wide(spark: SparkSession, sf_dir: str, civil: bool = False) -> DataFrame:
    return pivot_latest(adapters.feeder_measures(spark, sf_dir, civil, by_hour=True), "arrival")


def feeder_weather(spark: SparkSession, sf_dir: str, civil: bool = False) -> DataFrame:
    records = adapters.feeder_weather(spark, sf_dir, civil, by_hour=True)
    return weather_latest(records, f"struct(source = '{ARCHIVE_SOURCE}' as archived, arrival)")


class Stored(Mapping):
    """Gold tables that are written once each, when first asked for, and read from then on.

    Silver has one reader a lake, which takes some of its columns: it stays a plan, so that no column
    is joined, shuffled or written which that reader leaves out.
    """

    def __init__(self, tables: dict[str, DataFrame]):
        self._tables, self._written = tables, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name == "silver_grid_hourly":
            return self._tables[name]
        if name not in self._written:
            table = build_accuracy(self["fact_demand_hourly"]) if name == "fact_forecast_accuracy" else self._tables[name]
            self._written[name] = written(table, name)
        return self._written[name]

    def __iter__(self):
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)


_BUILT: dict[tuple[str, str, str], Stored] = remembered()


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], dict[str, DataFrame]]) -> Stored:
    """The gold tables of a lake, built once an application and folder; all queries read the same ones."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _BUILT:
        _BUILT[key] = Stored(build())
    return _BUILT[key]


def feeder_gold(spark: SparkSession, sf_dir: str, civil: bool = False) -> Stored:
    """The gold tables of the feeder lake, or of the one over a civil year."""

    def build():
        wide = written(feeder_wide(spark, sf_dir, civil), "measures_wide")
        dim = written(adapters.feeder_dimension(spark, sf_dir), "dim_ba")
        return build_gold(wide, dim, feeder_weather(spark, sf_dir, civil))

    return _once(spark, sf_dir, "civil" if civil else "feeder", build)


def feeder_fact(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The gold fact, whole or some columns of it."""
    fact = feeder_gold(spark, sf_dir)["fact_demand_hourly"]
    return fact.select(*columns) if columns else fact


def event_gold(spark: SparkSession, sf_dir: str) -> Stored:
    """The gold tables of the event feed: three authorities, no weather."""
    from wattloom.registry import authorities

    def build():
        wide = written(pivot_latest(adapters.event_measures(spark, sf_dir), EVENT_ARRIVAL), "measures_wide")
        return build_gold(wide, authorities(spark), None)

    return _once(spark, sf_dir, "events", build)


def r(expression: str, digits: int = 0) -> str:
    """SQL twin of ``half_up``."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38,{digits + 5})), {digits}) AS DOUBLE)"


def to(expression: str, step: int) -> str:
    return f"floor(({expression}) * {step} + 0.5::DOUBLE) / {step}"


# --------------------------------------------------------------------------- feeder lake in SQL

view(
    "feed_lines",
    """
    SELECT *, CAST(floor(l_suppkey / 20) AS BIGINT) AS g,
           date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS step,
           date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) % 24 AS h,
           l_orderkey * 8 + l_linenumber AS seq
    FROM lineitem
    """,
)
view(
    "feed_values",
    """
    SELECT *,
           TIMESTAMP '2022-11-07 00:00:00' + to_hours(step) AS period_utc,
           'BA' || repeat('0', 6 - length(CAST(g AS VARCHAR))) || CAST(g AS VARCHAR) AS ba_code,
           1000.0::DOUBLE * (1 + g % 5)
             * (CASE WHEN h < 6 THEN 0.9::DOUBLE ELSE 1.18::DOUBLE - abs(h - 15) * 0.02::DOUBLE END)
             * (1 + floor(l_quantity / 10) * 0.02::DOUBLE) AS plain,
           CASE WHEN l_linenumber = 7 AND l_quantity >= 49 THEN 10.0::DOUBLE
                WHEN l_linenumber = 6 AND l_quantity <= 1 THEN 0.0::DOUBLE
                WHEN l_linenumber = 5 AND l_tax = 0.08 AND l_quantity > 40 THEN 1.4::DOUBLE
                ELSE 1.0::DOUBLE END AS fault
    FROM feed_lines
    """,
)
view(
    "feed_long",
    f"""
    SELECT period_utc, ba_code, 'D' AS measure_code,
           CASE WHEN NOT (l_linenumber = 4 AND l_quantity >= 40) THEN {to('plain * fault', 10)} END AS value_mwh,
           l_shipdate AS ingested_at_utc, seq, l_partkey AS seq2 FROM feed_values
    UNION ALL
    SELECT period_utc, ba_code, 'DF',
           CASE WHEN NOT (l_returnflag = 'N' AND l_discount = 0)
                THEN {to('plain * (0.96::DOUBLE + 0.8::DOUBLE * l_discount)', 10)} END,
           l_shipdate, seq, l_partkey FROM feed_values
    UNION ALL
    SELECT period_utc, ba_code, 'NG', {to('plain * 1.03::DOUBLE', 10)}, l_shipdate, seq, l_partkey FROM feed_values
    UNION ALL
    SELECT period_utc, ba_code, 'TI', {to('plain * (l_tax - 0.04::DOUBLE)', 10)}, l_shipdate, seq, l_partkey FROM feed_values
    """,
)
view(
    "feed_latest",
    """
    SELECT period_utc, ba_code, measure_code, value_mwh, ingested_at_utc, seq, seq2 FROM (
        SELECT *, row_number() OVER (
                   PARTITION BY period_utc, ba_code, measure_code
                   ORDER BY ingested_at_utc DESC, seq DESC, seq2 DESC) AS rn
        FROM feed_long)
    WHERE rn = 1
    """,
)


def _pivot(source: str) -> str:
    return f"""
    SELECT period_utc, ba_code,
           max(CASE WHEN measure_code = 'D'  THEN value_mwh END) AS demand_mwh,
           max(CASE WHEN measure_code = 'DF' THEN value_mwh END) AS demand_forecast_mwh,
           max(CASE WHEN measure_code = 'NG' THEN value_mwh END) AS net_generation_mwh,
           max(CASE WHEN measure_code = 'TI' THEN value_mwh END) AS total_interchange_mwh
    FROM {source} GROUP BY period_utc, ba_code
    """


view("feed_wide", _pivot("feed_latest"))
view(
    "feed_weather_all",
    f"""
    SELECT period_utc, ba_code,
           CASE WHEN glitch THEN 99.0::DOUBLE
                WHEN NOT absent THEN temp END AS temperature_2m,
           CASE WHEN NOT absent THEN {to('50 + l_discount * 300', 10)} END AS relative_humidity_2m,
           CASE WHEN glitch THEN {to('99.0::DOUBLE - 5', 100)} WHEN NOT absent THEN {to('temp - 5', 100)} END AS dew_point_2m,
           CASE WHEN glitch THEN {to('99.0::DOUBLE - l_tax * 20', 100)}
                WHEN NOT absent THEN {to('temp - l_tax * 20', 100)} END AS apparent_temperature,
           l_quantity * 2 AS cloud_cover,
           CASE WHEN l_linenumber <> 1 THEN {to('l_tax * 100', 10)} END AS wind_speed_10m,
           greatest(0.0::DOUBLE, 600.0::DOUBLE - 50.0::DOUBLE * abs(h - 12)) AS shortwave_radiation,
           CASE WHEN l_linestatus = 'F' THEN 'era5_archive' ELSE 'forecast' END AS source,
           l_shipdate AS ingested_at_utc, seq, l_partkey AS seq2
    FROM (
        SELECT *, (l_linenumber = 3 AND l_quantity >= 45) AS absent,
               (l_linenumber = 2 AND l_quantity >= 50 AND l_tax = 0.08) AS glitch,
               {to('14 + (l_quantity - 25.5::DOUBLE) * 0.4::DOUBLE + (6 - abs(h - 14)) * 0.5::DOUBLE', 100)} AS temp
        FROM feed_values)
    """,
)
view(
    "feed_weather",
    """
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (
                   PARTITION BY ba_code, period_utc
                   ORDER BY (source = 'era5_archive') DESC, ingested_at_utc DESC, seq DESC, seq2 DESC) AS rn
        FROM feed_weather_all)
    WHERE rn = 1
    """,
)
view(
    "feed_dim",
    """
    SELECT 'BA' || repeat('0', 6 - length(CAST(g AS VARCHAR))) || CAST(g AS VARCHAR) AS ba_code, ba_name,
           CASE g % 4 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'America/Chicago'
                      WHEN 2 THEN 'America/Los_Angeles' ELSE 'America/Denver' END AS timezone,
           region, load_centre, 25.0::DOUBLE + g % 20 AS latitude, -120.0::DOUBLE + g % 50 AS longitude
    FROM (SELECT CAST(floor(s_suppkey / 20) AS BIGINT) AS g, min(s_name) AS ba_name,
                 min(r_name) AS region, min(n_name) AS load_centre
          FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
          GROUP BY 1)
    """,
)
view(
    "feed_spine",
    """
    SELECT ba_code, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS period_utc
    FROM (SELECT ba_code, min(period_utc) AS lo, max(period_utc) AS hi FROM feed_wide GROUP BY ba_code)
    """,
)

# All periods lie in winter, so the offsets are constant.
_OFFSET = """to_hours(CASE d.timezone WHEN 'America/New_York' THEN -5 WHEN 'America/Chicago' THEN -6
                           WHEN 'America/Denver' THEN -7 ELSE -8 END)"""


def _silver(spine: str, wide: str, dim: str, weather: str | None, offset: str = _OFFSET) -> str:
    """Hours with their local clock, then the readings of the hour and of the two hours before it, by joins on the hour."""
    names = (
        "temperature_2m", "relative_humidity_2m", "dew_point_2m", "apparent_temperature",
        "cloud_cover", "wind_speed_10m", "shortwave_radiation",
    )
    outside = f"SELECT ba_code, period_utc, {', '.join(names)} FROM {weather}" if weather else (
        f"SELECT ba_code, period_utc, {', '.join(f'NULL::DOUBLE AS {n}' for n in names)} FROM {spine}"
    )

    def earlier(hours: int) -> str:
        return f"SELECT ba_code, period_utc + to_hours({hours}) AS period_utc, demand_mwh AS demand_{hours} FROM {wide}"

    return f"""
    WITH clock AS (
        SELECT ba_code, period_utc, timezone, period_utc + {offset} AS period_local FROM {spine} JOIN {dim} d USING (ba_code)
    ), read AS (
        SELECT *, true AS was_read FROM {wide}
    )
    SELECT period_utc, ba_code, timezone, period_local, period_local::DATE AS date_local,
           date_part('hour', period_local) AS hour_local, date_part('isodow', period_local) AS iso_dow_local,
           demand_mwh, demand_forecast_mwh, net_generation_mwh, total_interchange_mwh, {', '.join(names)},
           demand_mwh IS NULL AS flag_missing_demand, coalesce(demand_mwh < 1, false) AS flag_nonpositive_demand,
           was_read IS NULL AS flag_absent_interval,
           CASE WHEN demand_mwh IS NULL THEN false ELSE demand_1 = demand_mwh AND demand_2 = demand_mwh END AS flag_frozen_reading
    FROM clock LEFT JOIN read USING (ba_code, period_utc)
    LEFT JOIN ({earlier(1)}) USING (ba_code, period_utc) LEFT JOIN ({earlier(2)}) USING (ba_code, period_utc)
    LEFT JOIN ({outside}) USING (ba_code, period_utc)
    """


view("feed_silver", _silver("feed_spine", "feed_wide", "feed_dim", "feed_weather"))

_HOLIDAY = """(
    (dow < 5 AND md IN (101, 704, 1111, 1225)) OR (dow < 5 AND md = 619 AND y >= 2021)
    OR (dow = 4 AND md_next IN (101, 704, 1111, 1225)) OR (dow = 4 AND md_next = 619 AND y >= 2021)
    OR (dow = 0 AND md_prev IN (101, 704, 1111, 1225)) OR (dow = 0 AND md_prev = 619 AND y >= 2021)
    OR (dow = 0 AND mon = 1 AND dom BETWEEN 15 AND 21 AND y >= 1986)
    OR (dow = 0 AND mon = 2 AND dom BETWEEN 15 AND 21)
    OR (dow = 0 AND mon = 5 AND dom >= 25)
    OR (dow = 0 AND mon = 9 AND dom <= 7)
    OR (dow = 0 AND mon = 10 AND dom BETWEEN 8 AND 14)
    OR (dow = 3 AND mon = 11 AND dom BETWEEN 22 AND 28))"""


def _dim_date(silver: str) -> str:
    return f"""
    SELECT date_day, year, quarter, month, day_of_month, day_of_week, day_of_year, week_of_year,
           is_weekend, is_holiday, NOT (is_weekend OR is_holiday) AS is_business_day, season,
           coalesce(lead(is_holiday) OVER (ORDER BY date_day), false) AS is_day_before_holiday,
           coalesce(lag(is_holiday) OVER (ORDER BY date_day), false) AS is_day_after_holiday
    FROM (
        SELECT date_day, y AS year, quarter(date_day) AS quarter, mon AS month, dom AS day_of_month, dow AS day_of_week,
               dayofyear(date_day) AS day_of_year, weekofyear(date_day) AS week_of_year, dow >= 5 AS is_weekend,
               {_HOLIDAY} AS is_holiday,
               CASE WHEN mon IN (12, 1, 2) THEN 'Winter' WHEN mon IN (3, 4, 5) THEN 'Spring'
                    WHEN mon IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season
        FROM (
            SELECT date_day, isodow(date_day) - 1 AS dow, year(date_day) AS y, month(date_day) AS mon, day(date_day) AS dom,
                   month(date_day) * 100 + day(date_day) AS md,
                   month(date_day + 1) * 100 + day(date_day + 1) AS md_next,
                   month(date_day - 1) * 100 + day(date_day - 1) AS md_prev
            FROM (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date_day
                  FROM (SELECT min(date_local) AS lo, max(date_local) + 20 AS hi FROM {silver}))))
    """


view("feed_dates", _dim_date("feed_silver"))


def _bounds(silver: str) -> str:
    """A fifth and five times the middle of a key's positive readings."""
    return f"""
    SELECT ba_code, middle AS median_demand, middle * 0.2::DOUBLE AS lower_bound, middle * 5::DOUBLE AS upper_bound
    FROM (SELECT ba_code, list_aggregate(list(demand_mwh) FILTER (demand_mwh > 0), 'median') AS middle FROM {silver} GROUP BY ALL)
    WHERE middle IS NOT NULL
    """


def _fact(silver: str, dates: str, bounds: str) -> str:
    """Step by step: the five readings around an hour, what they say about it, what may be trusted."""
    around = " ".join(
        f"LEFT JOIN (SELECT ba_code, period_utc + to_hours({-k}) AS period_utc, demand_mwh AS at_{'before' if k < 0 else 'after'}_{abs(k)} FROM {silver}) "
        "USING (ba_code, period_utc)" for k in (-2, -1, 1, 2)
    )
    return f"""
    WITH neighbours AS (
        SELECT * FROM {silver} {around}
    ), told AS (
        SELECT *, list_aggregate(list_filter([at_before_2, at_before_1, demand_mwh, at_after_1, at_after_2], lambda x: x IS NOT NULL), 'median') AS usual
        FROM neighbours LEFT JOIN {bounds} USING (ba_code)
    ), judged AS (
        SELECT *, 100 * abs(demand_mwh - at_before_1) / nullif(at_before_1, 0) > 40 AS flag_extreme_ramp,
               coalesce(demand_mwh, lower_bound) NOT BETWEEN lower_bound AND upper_bound AS flag_implausible_magnitude,
               CASE WHEN demand_mwh IS NULL OR usual IS NULL THEN false ELSE abs(demand_mwh - usual) / nullif(usual, 0) * 100 > 20 END AS flag_isolated_spike
        FROM told
    )
    SELECT period_utc, ba_code, date_local, hour_local, demand_mwh, demand_forecast_mwh, net_generation_mwh, total_interchange_mwh,
           temperature_2m, relative_humidity_2m, dew_point_2m, apparent_temperature, cloud_cover, wind_speed_10m, shortwave_radiation,
           CASE WHEN flag_nonpositive_demand OR flag_implausible_magnitude OR flag_isolated_spike OR flag_isolated_spike IS NULL THEN NULL ELSE demand_mwh END AS demand_clean_mwh,
           flag_missing_demand, flag_nonpositive_demand, flag_frozen_reading, flag_extreme_ramp, flag_implausible_magnitude, flag_isolated_spike,
           day_of_week, is_weekend, is_holiday, is_business_day, season, month, year, is_day_before_holiday, is_day_after_holiday
    FROM judged LEFT JOIN (SELECT * RENAME (date_day AS date_local) FROM {dates}) USING (date_local)
    """


def _accuracy(fact: str) -> str:
    return f"""
    SELECT * EXCLUDE (miss), miss AS error_mwh, abs(miss) AS abs_error_mwh, abs(miss) / nullif(actual_mwh, 0) * 100 AS abs_pct_error,
           if(miss > 0, 'over', 'under') AS bias_direction
    FROM (SELECT period_utc, ba_code, date_local, hour_local, demand_clean_mwh AS actual_mwh, demand_forecast_mwh AS eia_forecast_mwh,
                 demand_forecast_mwh - demand_clean_mwh AS miss FROM {fact})
    WHERE miss IS NOT NULL
    """


view("feed_bounds", _bounds("feed_silver"))
view("feed_fact", _fact("feed_silver", "feed_dates", "feed_bounds"))
view("feed_accuracy", _accuracy("feed_fact"))

# --------------------------------------------------------------------------- the feeder lake over a civil year


def civil(text: str) -> str:
    """A step of the feeder lake on the civil feed: the same records at other hours."""
    hours = "TIMESTAMP '2023-02-01 00:00:00' + to_hours(4 * step + l_orderkey % 4) AS period_utc"
    text = text.replace("TIMESTAMP '2022-11-07 00:00:00' + to_hours(step) AS period_utc", hours)
    return re.sub(r"\bfeed_(?!dim\b)", "civil_", text)


def sunday(month: int, first: int) -> str:
    """The first Sunday from a day of a month on, in the year of the hour."""
    day = f"make_date(year(period_utc), {month}, {first})"
    return f"({day} + CAST(7 - isodow({day}) AS INTEGER))::TIMESTAMP"


# Daylight saving begins at two, standard time, on the second Sunday of March, and ends at two, daylight time,
# on the first of November.
STANDARD = "CASE d.timezone WHEN 'America/New_York' THEN 5 WHEN 'America/Chicago' THEN 6 WHEN 'America/Denver' THEN 7 ELSE 8 END"
_CIVIL_OFFSET = f"""to_hours(CASE WHEN period_utc >= {sunday(3, 8)} + to_hours(2 + {STANDARD})
                               AND period_utc < {sunday(11, 1)} + to_hours(1 + {STANDARD}) THEN 1 ELSE 0 END - {STANDARD})"""

for _step in ("lines", "values", "long", "latest", "wide", "weather_all", "weather", "spine"):
    view(f"civil_{_step}", civil(VIEWS[f"feed_{_step}"]))
view("civil_silver", _silver("civil_spine", "civil_wide", "feed_dim", "civil_weather", _CIVIL_OFFSET))
for _step in ("dates", "bounds", "fact", "accuracy"):
    view(f"civil_{_step}", civil(VIEWS[f"feed_{_step}"]))

# --------------------------------------------------------------------------- event feed in SQL

view(
    "event_long",
    """
    SELECT date_trunc('hour', ts) AS period_utc,
           CASE user_id % 3 WHEN 0 THEN 'PJM' WHEN 1 THEN 'ERCO' ELSE 'CISO' END AS ba_code,
           CASE event_type WHEN 'view' THEN 'D' WHEN 'click' THEN 'DF' WHEN 'purchase' THEN 'NG'
                           WHEN 'signup' THEN 'TI' ELSE 'XX' END AS measure_code,
           value AS value_mwh, ts AS ingested_at_utc, event_id AS seq
    FROM events
    """,
)
view(
    "event_latest",
    """
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY period_utc, ba_code, measure_code
                                     ORDER BY ingested_at_utc DESC, seq DESC) AS rn
        FROM event_long)
    WHERE rn = 1
    """,
)
view("event_wide", _pivot("event_latest"))
view(
    "event_dim",
    """
    SELECT * FROM (VALUES ('PJM', 'America/New_York'), ('ERCO', 'America/Chicago'), ('CISO', 'America/Los_Angeles'))
        AS t(ba_code, timezone)
    """,
)
view(
    "event_spine",
    """
    SELECT ba_code, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS period_utc
    FROM (SELECT ba_code, min(period_utc) AS lo, max(period_utc) AS hi FROM event_wide GROUP BY ba_code)
    """,
)
view("event_silver", _silver("event_spine", "event_wide", "event_dim", None))
view("event_dates", _dim_date("event_silver"))
view("event_bounds", _bounds("event_silver"))
view("event_fact", _fact("event_silver", "event_dates", "event_bounds"))
view("event_accuracy", _accuracy("event_fact"))
