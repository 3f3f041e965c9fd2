from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shelfmatch import schemas as sc
from shelfmatch.operators import health as he
from shelfmatch.operators import merge
from shelfmatch.plans.match_run import COMPONENT, run_matching
from shelfmatch.plans.monitor_run import component_ages, run_monitor
from shelfmatch.sources.audit_log import AuditLog
from shelfmatch.sources.tables import KeyedTable
from tests.test_matching import ACCOUNT, account, store

NOW = datetime(2024, 1, 10, 12)


@pytest.mark.parametrize("age, wanted", [
    (timedelta(hours=26, minutes=59), None), (timedelta(hours=27), "stale_run"), (None, "no_successful_run")])
def test_freshness_limit(spark, age, wanted):
    runs = [("old", "job", None, "success", None, NOW - timedelta(days=9))]
    if age is None:
        runs = [("r", "job", None, "failure", None, NOW)]
    else:
        runs.append(("new", "job", None, "success", None, NOW - age))
    checks = spark.createDataFrame([("job", 26)], "component string, max_age_hours int")
    found = he.freshness_violations(checks, spark.createDataFrame(runs, sc.PIPELINE_RUNS), F.lit(NOW)).collect()
    assert [r["check_name"] for r in found] == ([wanted] if wanted else [])


def test_monitor_logs_problems_and_its_own_heartbeat(spark, tmp_path):
    audit = AuditLog(spark, f"file://{tmp_path}")
    audit.log_run("a")
    assert run_monitor(audit, watched=(("a", 26), ("b", 26))) == 1
    row = audit.errors.read().first()
    assert (row["component"], row["check_name"], row["test_type"], row["message"]) == (
        "b", "no_successful_run", "infrastructure", "b: never finished")
    assert sorted(r["component"] for r in audit.runs.read().collect()) == ["a", "pipeline-monitor"]
    assert run_monitor(audit, F.current_timestamp() + F.make_interval(hours=F.lit(30)), (("a", 26),)) == 1
    assert audit.errors.read().filter("check_name = 'stale_run'").count() == 1


def test_monitor_reads_the_last_days_first(spark, tmp_path, capsys):
    audit = AuditLog(spark, f"file://{tmp_path}")
    rows = [("r1", "a", None, "success", None, NOW - timedelta(days=40)), ("r2", "b", None, "success", None, NOW - timedelta(hours=3))]
    audit.runs.append(spark.createDataFrame(rows, sc.PIPELINE_RUNS))
    checks = spark.createDataFrame([("a", 26), ("b", 26)], "component string, max_age_hours int")
    ages = {r["component"]: r["age_hours"] for r in component_ages(audit, checks, F.lit(NOW)).collect()}
    assert ages == {"a": 960, "b": 3}
    recent = audit.runs.read(since=F.lit(NOW) - F.make_interval(hours=F.lit(50)))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(finished_at_day" in recent


def test_day_folders_do_not_depend_on_the_time_zone(spark, tmp_path):
    table = AuditLog(spark, f"file://{tmp_path}").runs
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
        table.append(spark.sql("select 'r' as run_id, 'a' as component, 'success' as status, timestamp_seconds(1704844800) as finished_at"))
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert table.read(since=F.timestamp_seconds(F.lit(1704844800))).count() == 1
        assert [p.name for p in (tmp_path / "pipeline_runs").glob("finished_at_day=*")] == ["finished_at_day=2024-01-10"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_errors_leave_the_window(spark):
    rows = [(str(i), NOW - timedelta(hours=i), "c", None, "k", "ERROR" if i % 2 else "WARNING", None, None, None)
            for i in range(30)]
    errors = spark.createDataFrame(rows, sc.PIPELINE_ERRORS)
    assert he.error_window_violations(errors, F.lit(NOW), 3).count() == 2
    assert he.error_window_violations(errors, F.lit(NOW + timedelta(days=3)), 3).isEmpty()
    assert [r["occurred_at"] for r in he.recent_errors(errors, F.lit(NOW), limit=2).collect()] == [
        NOW, NOW - timedelta(hours=1)]


def test_contract(spark, tmp_path):
    """Files of one table in three schemas; footers tell, rows are not read."""
    rows = spark.createDataFrame([], ACCOUNT)
    broken = rows.drop("revenue").withColumn("case_volume", F.lit("1"))
    for name, df in (("good", rows), ("bad", broken), ("wide", rows.withColumn("more", F.array(F.lit(1))))):
        df.coalesce(1).write.parquet(f"file://{tmp_path}/{name}")

    def found(pattern):
        files = spark.read.format("binaryFile").load(f"file://{tmp_path}/{pattern}/*.parquet")
        return {(r["column_name"], r["violation"], r["found"], r["files"]) for r in he.contract_violations(files, sc.DISTRIBUTOR_ACCOUNTS).collect()}

    assert found("*") == {("revenue", "missing_column", None, 1), ("case_volume", "wrong_type", "string", 1)}
    assert found("good") == found("wide") == set()


def test_keys_and_required_columns(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2), ("b", 3)], "k string, n int")
    assert {(r["key_value"], r["rows"]) for r in he.key_violations(df, "k").collect()} == {("a", 2), (None, 1)}
    assert [tuple(r) for r in he.null_violations(df, ["k", "n"]).collect()] == [("k", 1), ("n", 1)]
    assert sc.required_columns(sc.STORES_NORMALIZED) == ["store_id", "ingested_at", "source_file"]


def test_declared_tables_can_be_created_from_ddl(spark):
    for schema in sc.TABLES.values():
        made = spark.createDataFrame([], schema.toDDL()).schema
        assert [(f.name, f.dataType) for f in made] == [(f.name, f.dataType) for f in schema]


def universe(spark, tmp_path):
    return (KeyedTable(spark, f"file://{tmp_path}/universe", sc.ACCOUNT_UNIVERSE, "store_id"),
            AuditLog(spark, f"file://{tmp_path}"))


def scratch_folders(spark):
    from pathlib import Path

    return set(Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://")).iterdir())


def test_match_runs(spark, tmp_path):
    audit = AuditLog(spark, f"file://{tmp_path}")
    table = KeyedTable(spark, f"file://{tmp_path}/universe", sc.ACCOUNT_UNIVERSE, "store_id")
    before = scratch_folders(spark)
    accounts = spark.createDataFrame([account("A", "1 A", "Dover")], ACCOUNT)
    stores = spark.createDataFrame([store("A", "1 A", "Dover", store_id="a"), store("B", "2 B", "Dover", store_id="b")],
                                   sc.MATCHER_INPUT)

    def state():
        return {r["store_id"]: (r["any_distributor_match"], r["run_date"].day) for r in table.read().collect()}

    assert run_matching(stores.filter("store_id = 'a'"), accounts, table, audit, now=datetime(2024, 1, 1)).matched == 1
    assert run_matching(stores, accounts, table, audit, now=datetime(2024, 1, 2)).processed == 1
    assert state() == {"a": (True, 1), "b": (False, 2)}
    written = spark.read.parquet(f"file://{tmp_path}/universe").groupBy("load").count().collect()
    assert [r["count"] for r in written] == [1, 1]  # an incremental run writes its new rows only
    assert run_matching(stores, accounts, table, audit).processed == 0
    run_matching(stores.filter("store_id = 'b'"), accounts, table, audit, "full", datetime(2024, 1, 4))
    assert state() == {"b": (False, 4)}
    errors = audit.errors.read().collect()
    assert [(r["check_name"], r["context"]) for r in errors] == [("zero_stores_matched", '{"processed":1,"matched":0}')]
    run_matching(stores.filter("false"), accounts, table, audit, "full")
    assert state() == {"b": (False, 4)}
    assert audit.runs.read().filter(F.col("component") == COMPONENT).count() == 5
    with pytest.raises(ValueError):
        run_matching(stores, accounts, table, audit, "partial")
    assert scratch_folders(spark) == before


def test_failed_match_run_is_recorded(spark, tmp_path):
    table, audit = universe(spark, tmp_path)
    stores = spark.createDataFrame([store("A")], sc.MATCHER_INPUT)
    with pytest.raises(Exception):
        run_matching(stores, spark.createDataFrame([], ACCOUNT).drop("clean_name"), table, audit)
    row = audit.errors.read().first()
    assert (row["check_name"], row["context"]) == ("unhandled_exception", '{"mode":"incremental"}')
    assert audit.runs.read().isEmpty()


def test_licences_without_a_store_become_stores(spark):
    stores = spark.createDataFrame([("a", "A")], "store_id string, store_name string")
    licences = spark.createDataFrame(
        [("1", "a", "x", "c", "NJ"), ("2", "a", "x", "c", "NJ"), ("3", None, "y", "c", "NJ"), ("4", "gone", "z", "c", "NJ")],
        "licence_number string, store_id string, licensee string, city string, state string")
    rows = {r["store_id"]: (r["store_name"], r["nj_abc_license_number"]) for r in merge.matcher_input(
        stores, licences).collect()}
    assert rows == {"a": ("A", "2"), "nj-abc:3": ("y", "3"), "nj-abc:4": ("z", "4")}
