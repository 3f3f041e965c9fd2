import pytest

from pyspark.sql import functions as F

from shelfmatch.operators import merge
from shelfmatch.schemas import STORES_NORMALIZED, add_missing_columns
from shelfmatch.sources.tables import AppendTable, KeyedTable


@pytest.fixture
def target(spark):
    return spark.createDataFrame([("a", 1, "x"), ("b", 2, None)], "store_id string, n int, zip string")


@pytest.fixture
def source(spark):
    return spark.createDataFrame([("b", 20, "z"), ("c", 30, "y")], "store_id string, n int, zip string")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_is_idempotent(target, source):
    once = merge.upsert(target, source)
    assert rows(once) == [("a", 1, "x"), ("b", 20, "z"), ("c", 30, "y")]
    assert rows(merge.upsert(once, source)) == rows(once)


def test_insert_new_leaves_rows_alone(target, source):
    once = merge.insert_new(target, source)
    assert rows(once.filter("store_id <> 'b'")) == [("a", 1, "x"), ("c", 30, "y")]
    assert rows(once.filter("store_id = 'b'")) == [("b", 2, None)]
    assert merge.insert_new(once, source).count() == 3


def test_full_sync_takes_the_source_unless_it_is_empty(target, source):
    assert rows(merge.full_sync(target, source)) == rows(source)
    assert merge.full_sync(target, source.filter("n < 0")).count() == 2


def test_fill_missing(spark, target):
    wide = add_missing_columns(target, {"lat": "double"})
    updates = spark.createDataFrame([("b", "9", 1.5), ("d", "8", 2.5)], "store_id string, zip string, lat double")
    once = merge.fill_missing(wide, updates, ["zip"], ["lat"])
    assert sorted((r["store_id"], r["zip"], r["lat"]) for r in once.collect()) == [("a", "x", None), ("b", "9", 1.5)]
    again = merge.fill_missing(once, spark.createDataFrame([("b", "7", 9.9)], updates.schema), ["zip"], ["lat"])
    assert [(r["zip"], r["lat"]) for r in again.filter("store_id = 'b'").collect()] == [("7", 1.5)]


def test_last_per_key_takes_nulls_as_least(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 1, "m"), ("a", 0, "z"), ("b", None, "q")], "k string, n int, v string")
    assert rows(merge.last_per_key(df, "k", ["n"])) == [("a", 1, "m"), ("b", None, "q")]


def test_added_columns_keep_existing_ones(target):
    wide = add_missing_columns(target, {"zip": "double", "rating": "double"})
    assert wide.dtypes[2:] == [("zip", "string"), ("rating", "double")]


@pytest.mark.parametrize("size, n", [(100, 1), (100, 100), (100, 101), (7, 1000)])
def test_batches_follow_key_order(spark, size, n):
    df = spark.range(n).selectExpr("lpad(cast((id * 7919) % 100003 as string), 6, '0') as store_id").repartition(5)
    found = sorted((r["store_id"], r["batch_id"]) for r in merge.batch_of(df, "store_id", size).collect())
    assert [b for _, b in found] == [i // size for i in range(n)]


@pytest.fixture
def table(spark, tmp_path, target):
    return KeyedTable(spark, f"file://{tmp_path}/t", target.schema, "store_id", buckets=3)


def folders(tmp_path):
    return sorted(str(p.relative_to(tmp_path / "t")) for p in (tmp_path / "t").glob("snapshot=*/load=*"))


def test_table_replaces_what_it_reads(tmp_path, table, target):
    assert table.read().count() == 0 and table.keys().count() == 0
    table.replace(target)
    table.replace(table.read().selectExpr("store_id", "n + 1 as n", "zip"))
    table.replace(table.read().filter("store_id = 'a'"))
    assert rows(table.read()) == [("a", 2, "x")]
    assert folders(tmp_path) == ["snapshot=1/load=all", "snapshot=2/load=all"]  # the one before stays for its readers


def test_table_replays_and_rewrites(tmp_path, table, target, source):
    table.upsert(target, "one-0")
    table.upsert(source, "one-1")
    wanted = [("a", 1, "x"), ("b", 20, "z"), ("c", 30, "y")]
    assert rows(table.read()) == wanted
    table.upsert(source, "one-1")  # a replay writes its own folder again
    assert rows(table.read()) == wanted and len(folders(tmp_path)) == 2
    table.rewrite()
    assert rows(table.read()) == wanted
    table.upsert(target.filter("store_id = 'a'").selectExpr("store_id", "99 as n", "zip"))
    assert rows(table.read()) == [("a", 99, "x"), *wanted[1:]]
    table.upsert(target.filter("store_id = 'a'"), "two-0")  # another stream starts to count anew
    table.insert_new(target.selectExpr("store_id", "0 as n", "zip").unionByName(source.selectExpr("'d' as store_id", "4 as n", "zip").limit(1)))
    assert rows(table.read()) == [*wanted, ("d", 4, "z")]
    assert {r[0] for r in rows(table.keys())} == {"a", "b", "c", "d"}


def test_a_snapshot_that_is_still_written_does_not_count(spark, tmp_path, table, target, source):
    table.replace(target)
    (tmp_path / "t" / "snapshot=1" / "load=all" / "_temporary").mkdir(parents=True)
    assert rows(table.read()) == rows(target)
    table.replace(source)
    assert rows(KeyedTable(spark, table.root, target.schema, "store_id", 3).read()) == rows(source)


def test_a_delta_meets_the_table_where_it_lies(spark, tmp_path, table, target, source):
    """Anti-joins and reads by key shuffle the delta only: nothing is exchanged above the table's own scan."""
    table.upsert(target)
    table.upsert(source)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        delta = spark.createDataFrame([("c", 1), ("e", 2)], "store_id string, n int")
        fresh = merge.not_in(delta, table.keys(), "store_id")
        plans = {name: df._jdf.queryExecution().executedPlan().toString() for name, df in (("anti", fresh), ("read", table.read()))}
        assert [r[0] for r in rows(fresh)] == ["e"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Bucketed: true" in plans["read"] and plans["read"].count("Exchange") == 0
    anti = plans["anti"]
    assert "Bucketed: true" in anti and anti.count("Exchange") == 1
    assert anti.index("Exchange") < anti.index("LocalTableScan" if "LocalTableScan" in anti else "Scan ExistingRDD") < anti.index("Bucketed: true")


def test_last_rows_need_no_sort_aggregate_and_one_row_a_task(spark, target):
    plan = merge.last_per_key(target, "store_id", ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("WindowGroupLimit") == 2 and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_added_columns(spark, table, target, source):
    table.replace(target)
    table.add_columns({"lat": "double", "zip": "string"})
    table.add_columns({"lat": "double"})
    assert table.read().columns == [*target.columns, "lat"]
    table.upsert(table.read().filter("store_id = 'a'").withColumn("lat", F.lit(1.5)))
    table.upsert(target.selectExpr("store_id", "n + 7 as n", "zip"))  # knows nothing of the column
    again = KeyedTable(spark, table.root, target.schema, "store_id", 3)
    assert rows(again.read()) == [("a", 8, "x", 1.5), ("b", 9, None, None)]
    again.rewrite()
    assert rows(again.read()) == [("a", 8, "x", 1.5), ("b", 9, None, None)]


def test_append_table_reads_a_window(spark, tmp_path):
    from datetime import datetime

    schema = STORES_NORMALIZED
    df = spark.createDataFrame(
        [("a", datetime(2024, 1, 1, 5), "f"), ("b", datetime(2024, 1, 2, 5), "f"), ("c", datetime(2024, 1, 2, 7), "f")],
        "store_id string, ingested_at timestamp, source_file string")
    table = AppendTable(spark, f"file://{tmp_path}/t", schema, "ingested_at")
    assert table.read().count() == 0
    table.append(df)
    table.append(df.limit(1))
    assert table.read().count() == 4 and table.read().columns == schema.names
    recent = table.read(since=datetime(2024, 1, 2, 6))
    assert [r["store_id"] for r in recent.collect()] == ["c"]
    assert "PartitionFilters: [isnotnull(ingested_at_day" in recent._jdf.queryExecution().toString()
