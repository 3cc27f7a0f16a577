import pytest

from wattloom.plans import guard, quality
from wattloom.schemas import QUERY_TABLES


# ------------------------------------------------------------------ quality


def test_the_sixteen_checks_are_well_formed():
    names = [c.name for c in quality.CHECKS]
    assert len(names) == len(set(names)) == 16
    assert {c.dimension for c in quality.CHECKS} == set(quality.DIMENSIONS)
    assert all(0 <= c.threshold <= 1 and c.severity in quality.WEIGHTS and c.description for c in quality.CHECKS)


@pytest.fixture(scope="module")
def results(gold):
    return quality.run_suite(gold, "timestamp'2024-01-24'", "timestamp'2024-03-01'")


def test_clean_data_passes_every_critical_check(results):
    rows = {r["check_name"]: r for r in results.collect()}
    assert len(rows) == 16 and not any(r["error"] for r in rows.values())
    assert [n for n, r in rows.items() if r["severity"] == "critical" and not r["passed"]] == []
    top = quality.verdict(results).first()
    assert top["suite_passed"] and 80 <= top["score"] <= 100
    assert quality.scorecard(results).count() == 6


def test_a_broken_check_is_a_failed_check(gold):
    broken = quality.Check("broken", "validity", "critical", "refers to nothing", failed="sum(no_such_column)", total="sum(n)")
    rows = {r["check_name"]: r for r in quality.run_suite(gold, checks=(broken, quality.CHECKS[0])).collect()}
    assert not rows["broken"]["passed"] and "no_such_column" in rows["broken"]["error"]
    assert rows["demand_not_null"]["passed"]


def test_an_empty_fact_has_rate_zero(gold):
    empty = {**gold, "fact_demand_hourly": gold["fact_demand_hourly"].where("false")}
    rows = {r["check_name"]: r for r in quality.run_suite(empty).collect()}
    assert rows["demand_not_null"]["passed"] and rows["demand_not_null"]["total_rows"] == 0
    assert not rows["all_bas_present"]["passed"] and rows["all_bas_present"]["failed_rows"] == 3


def test_scorecard_uses_the_latest_run_only(results):
    older = results.selectExpr("timestamp'2020-01-01' as run_at_utc", *[c if c != "passed" else "false as passed" for c in results.columns[1:]])
    assert quality.verdict(older.unionByName(results)).first() == quality.verdict(results).first()


# ------------------------------------------------------------------ guarded SQL


PLAIN = [
    "select hour_local, max(demand_mwh) from fact_demand_hourly group by hour_local having max(demand_mwh) > 5",
    "with busy as (select ba_code from anomaly_scores where is_anomaly) select d.region from dim_ba d join busy using (ba_code)",
    "select date_local, row_number() over (partition by ba_code order by demand_mwh desc) as nth from fact_demand_hourly",
    "select * from dim_ba except select * from dim_ba where exists (select 1 from anomaly_scores)",
    "select 'drop; delete' as note, `delete` from (select region as `delete` from dim_ba) -- trailing remark",
    "(select 1) union all (select 2)",
]


@pytest.mark.parametrize("text", PLAIN)
def test_plain_queries_are_bounded(spark, text):
    bounded = guard.guard_sql(spark, text, max_rows=321)
    assert bounded.endswith("LIMIT 321") and text in bounded


def test_own_limits_stand(spark):
    own = "select ba_code from dim_ba order by 1 limit 3"
    assert guard.guard_sql(spark, f"Here you are:\n```sql\n{own};\n```\nEnjoy") == own
    for text in ("select ba_code from dim_ba limit all", "select * from (select * from dim_ba limit 2) as x", "select ba_code from dim_ba offset 1"):
        assert guard.guard_sql(spark, text, max_rows=9).endswith("LIMIT 9")


@pytest.mark.parametrize(
    "text",
    [
        "with x as (select 1) delete from dim_ba",
        "with x as (select 1 as a) update dim_ba set region = 'x'",
        "merge into dim_ba using anomaly_scores on true when matched then delete",
        "with x as (select 1) insert into dim_ba select * from x",
        "from dim_ba insert overwrite table dim_ba select *",
        "truncate table dim_ba", "refresh table dim_ba", "cache table dim_ba", "set spark.sql.ansi.enabled = false", "explain select 1", "use other",
        "select 1; select 2", "select 1 from dim_ba; drop table dim_ba", "", "```\n```", "select region from dim_ba where (",
        "select transform(region) using 'sh' as (y) from dim_ba",
        "select * from dim_ba lateral view explode(array(1)) t as x",
    ],
)
def test_only_one_plain_query_passes(spark, text):
    with pytest.raises(guard.GuardError):
        guard.guard_sql(spark, text)


@pytest.mark.parametrize(
    "call",
    [
        "java_method('java.lang.System', 'getProperty', 'user.dir')", "`java_method`('java.lang.System', 'getProperty', 'user.dir')", "`Reflect`('a', 'b')",
        "system.builtin.java_method('a', 'b')", "spark_catalog.default.mine(1)", "input_file_name()", "current_user()", "not_a_function(1)",
    ],
)
@pytest.mark.parametrize("frame", ["select {} from dim_ba", "select 1 from dim_ba where region = (select max({}) from dim_ba)", "select 1 from dim_ba order by {}"])
def test_functions_are_read_from_the_parsed_text(spark, call, frame):
    with pytest.raises(guard.GuardError, match="is not available"):
        guard.guard_sql(spark, frame.format(call))


@pytest.mark.parametrize(
    "text",
    [
        "select * from payroll", "select * from dim_ba cross join payroll", "select * from other.dim_ba", "select * from json.`/data/x.json`",
        "select case when exists (select 1 from payroll) then 1 end from dim_ba", "with dim_ba as (select * from payroll) select * from dim_ba",
        "select * from (with inner_one as (select 1) select * from inner_one) t, inner_one",
    ],
)
def test_tables_outside_the_list_are_refused(spark, text):
    with pytest.raises(guard.GuardError, match="unknown table"):
        guard.guard_sql(spark, text)


@pytest.mark.parametrize("text", ["select * from range(9)", "select * from explode(array(1, 2))", "select * from identifier('dim_ba')"])
def test_table_functions_are_refused(spark, text):
    with pytest.raises(guard.GuardError):
        guard.guard_sql(spark, text)


def test_no_more_rows_than_allowed(spark):
    spark.range(64).createOrReplaceTempView("counted")
    assert guard.guarded_sql(spark, "select id from counted limit 50", {"counted"}, max_rows=12).count() == 12
    assert [r.id for r in guard.guarded_sql(spark, "select id from counted order by id desc", {"counted"}, max_rows=2).collect()] == [63, 62]
    assert guard.truncation_warning(12, 12) and guard.truncation_warning(11, 12) is None
    assert "fact_demand_hourly" in QUERY_TABLES
