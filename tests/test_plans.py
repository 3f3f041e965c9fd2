"""Physical plans: what reaches the scan, and which joins Spark picks."""

import pytest

from shelfmatch.checks import queries as q
from shelfmatch.checks.fixtures import load
from shelfmatch.operators import accounts as ac
from shelfmatch.operators import geocoding as gc
from shelfmatch.operators import health as he
from shelfmatch.operators import matching as ma
from shelfmatch.schemas import PIPELINE_RUNS, STORE_GEOCODES

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def sides(spark):
    return q.match_sides(lambda name: load(spark, DATA, name))


@pytest.fixture
def no_broadcast(spark):
    """Sizes as on a cluster: nothing is small enough to be copied to every task."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("layer", [ma.match_exact_address, ma.match_exact_name, ma.match_fuzzy])
def test_match_layers_only_use_equi_joins(sides, no_broadcast, layer):
    text = plan(layer(*sides))
    assert "SortMergeJoin" in text or "ShuffledHashJoin" in text
    for bad in ("NestedLoop", "Cartesian", "BatchEvalPython"):
        assert bad not in text


def test_fuzzy_matching_scores_each_pair_once(sides):
    text = plan(ma.match_fuzzy(*sides, layers=(ma.FUZZY_ZIP,)))
    assert text.count("MapInArrow") == 1 and "ArrowEvalPython" not in text


def test_winning_accounts_are_aggregated_before_the_shuffle(sides):
    text = plan(ac.last_by_key(sides[1], "norm_addr"))
    assert "partial_max" in text and text.count("Exchange") == 1


def test_worklist_filters_and_columns_reach_the_scan(spark, tmp_path, no_broadcast):
    path = f"file://{tmp_path}/mart"
    schema = "store_id string, address string, parsed_city string, state string, zip string, latitude double, junk string"
    spark.createDataFrame([], schema).write.parquet(path)
    cached = f"file://{tmp_path}/cached"
    spark.createDataFrame([], STORE_GEOCODES).write.parquet(cached)
    text = gc.pending_geocodes(spark.read.parquet(path), spark.read.parquet(cached)).select("store_id")
    formatted = text._jdf.queryExecution().toString()
    assert "IsNull(latitude)" in formatted and "IsNotNull(address)" in formatted
    assert "struct<store_id:string,address:string,latitude:double>" in formatted
    assert "struct<store_id:string>" in formatted and "LeftAnti" in formatted


def test_heartbeat_filter_reaches_the_scan(spark, tmp_path):
    path = f"file://{tmp_path}/runs"
    spark.createDataFrame([], PIPELINE_RUNS).write.parquet(path)
    text = he.last_success(spark.read.parquet(path))._jdf.queryExecution().toString()
    assert "EqualTo(status,success)" in text and "struct<component:string,status:string,finished_at:timestamp>" in text
