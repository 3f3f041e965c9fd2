import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shelfmatch import schemas as sc
from shelfmatch.functions import geo
from shelfmatch.operators import geocoding as gc
from shelfmatch.plans.geocode_run import backfill_zips, paced, run_geocoding
from shelfmatch.sources.audit_log import AuditLog
from shelfmatch.sources.batch_geocoder import parse_reply_lines, read_replies
from shelfmatch.sources.tables import AppendTable, KeyedTable


def reply(*components, status="OK"):
    return json.dumps({"status": status, "results": [{
        "geometry": {"location": {"lat": 51.25, "lng": -3.5}, "location_type": "RANGE_INTERPOLATED"},
        "formatted_address": "48 Quarry St, Orrin", "address_components": [
            {"types": list(types), "short_name": name} for types, name in components]}]})


STREET, LONG_ZIP = (("route",), "Quarry St"), (("x", "postal_code"), "05521-9876")
MART = "store_id string, address string, parsed_city string, state string, zip string, latitude double"


def test_zip_of_a_reply(column):
    def first_zip(body):
        return geo.reply_zip(F.get(geo.parse_reply(body)["results"], F.lit(0)))

    assert column(first_zip, (reply(STREET, (("postal_code",), "05521")),), (reply(LONG_ZIP),), (reply(STREET),),
                  (reply(),), (reply((("postal_code",), "")),), ('{"status":"OK","results":[{}]}',)) == [
        "05521", "05521", None, None, None, None]


def test_replies_are_classified(spark):
    bodies = {"ok": reply(LONG_ZIP), "zero": '{"status":"ZERO_RESULTS","results":[]}',
              "bad": '{"status":"INVALID_REQUEST"}', "denied": '{"status":"REQUEST_DENIED","error_message":"key"}',
              "hollow": '{"status":"OK","results":[]}', "vague": reply().replace("51.25", '"north"'),
              "limit": '{"status":"OVER_QUERY_LIMIT"}', "junk": "<html>", "none": None}
    raw = spark.createDataFrame(list(bodies.items()), "store_id string, body string")
    rows = {r["store_id"]: r for r in gc.classify_replies(raw).collect()}
    assert {k: r["geocode_status"] for k, r in rows.items()} == {
        "ok": "OK", "zero": "ZERO_RESULTS", "bad": "INVALID_REQUEST", "denied": "TRANSIENT", "limit": "TRANSIENT",
        "hollow": "TRANSIENT", "vague": "TRANSIENT",
        "junk": "TRANSIENT", "none": "TRANSIENT"}
    assert rows["ok"].asDict() == dict(
        store_id="ok", geocode_status="OK", lat=51.25, lng=-3.5, zip="05521", formatted_address="48 Quarry St, Orrin",
        location_type="RANGE_INTERPOLATED")
    stored = gc.geocode_rows(gc.classify_replies(raw), F.lit(datetime(2024, 1, 1)))
    assert sorted(r["store_id"] for r in stored.collect()) == ["bad", "ok", "zero"]
    assert stored.columns == sc.STORE_GEOCODES.names


def test_query_skips_nulls_and_keeps_blanks(column):
    assert column(geo.geocode_query, ("1 A", None, "NJ", ""), (None, None, None, None)) == ["1 A, NJ, ", ""]


def test_batch_zip_and_point(column):
    assert column(geo.batch_zip, ("9 LARCH RD, VELDEN, NJ, 05544",), ("54321 LARCH RD, VELDEN, NJ",), ("1 A, B",),
                  ("1 A, 07001-1234 08002",), ("123456, 1",), ("",)) == ["05544", "54321", None, "07001", None, None]
    points = column(geo.batch_point, ("-74.1,40.5",), ("-74.1,x",), ("",), ("-74.1",), (" -1, 2 ",), ("1,2,3",))
    assert [tuple(p) for p in points] == [(40.5, -74.1), (None, None), (None, None), (None, None), (2.0, -1.0), (None, None)]


def test_reply_lines(spark):
    lines = ['"a","1 A, B, NJ, ","Match","Exact","1 A ST, B, NJ, 07001","-74.1,40.5","1","L"',
             '"b","x","No_Match"', '"c","x","tied","Exact","2 C, 07002","","1","L"', '"d","x","Match","Exact","3 D","1,2"',
             '"e","x","Tie"', 'f,x,Match,Exact,"4 ""F"", 07004"']
    raw = parse_reply_lines(spark.createDataFrame([(v,) for v in lines], "value string"))
    assert sorted(tuple(r) for r in gc.batch_updates(raw).collect()) == [
        ("a", "07001", 40.5, -74.1), ("c", "07002", None, None)]


@pytest.fixture
def mart(spark):
    return spark.createDataFrame(
        [("a", "1 A", "X", "NJ", None, None), ("b", "2 B", None, "NJ", "07001", None), ("c", "3 C", "X", "NJ", None, 1.5),
         ("d", None, "X", "NJ", None, None), ("e", "5 E", "X", "NJ", None, None)], MART)


def test_limit(spark, mart):
    nothing = spark.createDataFrame([], sc.STORE_GEOCODES)
    assert [tuple(r) for r in gc.geocode_requests(mart, nothing, 2).collect()] == [
        ("a", "1 A, X, NJ"), ("b", "2 B, NJ, 07001")]
    assert [r["store_id"] for r in gc.geocode_requests(mart, nothing, 0).collect()] == ["a"]


def test_reruns_ask_only_for_what_is_open(spark, tmp_path, mart):
    table = AppendTable(spark, f"file://{tmp_path}/geocodes", sc.STORE_GEOCODES)
    audit = AuditLog(spark, f"file://{tmp_path}")
    asked = []

    def resolver(bodies):
        def resolve(requests):
            asked.append([r["store_id"] for r in requests.orderBy("store_id").collect()])
            known = spark.createDataFrame(list(bodies.items()), "store_id string, body string")
            return requests.join(known, "store_id").select("store_id", "body")
        return resolve

    first = resolver({"a": reply(LONG_ZIP), "b": '{"status":"ZERO_RESULTS"}', "e": '{"status":"UNKNOWN_ERROR"}'})
    assert run_geocoding(mart, table, first, audit) == (
        "pending 3, processed 3, geocoded 1, unresolvable 1, transient 1, remaining 1")
    assert run_geocoding(mart, table, resolver({"e": reply()}), audit, limit=1).endswith("remaining 0")
    assert run_geocoding(mart, table, resolver({}), audit).startswith("pending 0, processed 0")
    assert asked == [["a", "b", "e"], ["e"]]
    again = gc.forget(table.read(), spark.createDataFrame([("b",)], "store_id string"))
    assert [r["store_id"] for r in gc.pending_geocodes(mart, again).collect()] == ["b"]
    assert audit.runs.read().count() == 3 and audit.errors.read().count() == 0
    assert [r["store_id"] for r in gc.unresolved(table.read()).collect()] == ["b"]


def test_locations_prefer_the_stores_own(spark):
    stores = spark.createDataFrame(
        [("own", "1", 1.0, 1.0), ("coded", None, None, None), ("centre", "2", None, None), ("none", "9", None, None)],
        "store_id string, zip string, lat double, lng double")
    day = lambda n: datetime(2024, 1, n)
    codes = spark.createDataFrame(
        [("own", 5.0, 5.0, "2", day(1)), ("coded", 4.0, 4.0, "9", day(1)), ("coded", 6.0, 6.0, "2", day(2))],
        "store_id string, lat double, lng double, zip string, geocoded_at timestamp")
    zips = spark.createDataFrame([("2", 7.0, 7.0, 10.0, "rural", "Essex")],
                                 "zip string, latitude double, longitude double, pop_density_sqmi double, "
                                 "area_type string, county string")
    rows = {r["store_id"]: (r["latitude"], r["zip"], r["county"]) for r in gc.locate_stores(stores, codes, zips).collect()}
    assert rows == {"own": (1.0, "1", None), "coded": (6.0, "2", "Essex"), "centre": (7.0, "2", "Essex"),
                    "none": (None, "9", None)}


def test_backfill_fills_zips_and_missing_points(spark, tmp_path):
    schema = "store_id string, address string, parsed_city string, state string, zip string, lat double, lng double"
    table = KeyedTable(spark, f"file://{tmp_path}/stores", spark.createDataFrame([], schema).schema, "store_id")
    table.replace(spark.createDataFrame(
        [("a", "1, A St", "X, Y", "NJ", None, 9.0, None), ("b", "2 B", None, None, None, None, None),
         ("c", "3 C", "Z", "NJ", "07003", None, None)], schema))
    lines = []

    def service(requests):
        lines.extend(r["line"] for r in requests.orderBy("store_id").collect())
        return spark.createDataFrame([("a", "Match", "1 A ST, 07001", "-74.1,40.5"), ("b", "No_Match", "", "")],
                                     "store_id string, match_flag string, matched_address string, coords string")

    assert backfill_zips(table, service) == (1, 2)
    assert lines == ["a,1  A St,X  Y,NJ,", "b,2 B,,,"]
    assert sorted((r["store_id"], r["zip"], r["lat"], r["lng"]) for r in table.read().collect()) == [
        ("a", "07001", 9.0, -74.1), ("b", None, None, None), ("c", "07003", None, None)]


def test_a_failing_run_keeps_what_was_answered(spark, tmp_path):
    mart = spark.createDataFrame([(f"s{i}", f"{i} A", "X", "NJ", None, None) for i in range(8)], MART)
    table, audit = AppendTable(spark, f"file://{tmp_path}/geocodes", sc.STORE_GEOCODES), AuditLog(spark, f"file://{tmp_path}")
    calls = []

    def resolve(requests):
        calls.append([r["store_id"] for r in requests.orderBy("store_id").collect()])
        if len(calls) == 3:
            raise OSError("service gone")
        return requests.select("store_id", F.lit(reply(LONG_ZIP)).alias("body"))

    with pytest.raises(OSError):
        run_geocoding(mart, table, resolve, audit, rounds=4, least=2)
    assert sorted(r["store_id"] for r in table.read().collect()) == ["s0", "s1", "s2", "s3"]
    assert run_geocoding(mart, table, resolve, audit, rounds=2, least=1) == (
        "pending 4, processed 4, geocoded 4, unresolvable 0, transient 0, remaining 0")
    assert calls[3:] == [["s4", "s5"], ["s6", "s7"]]


def test_rounds_are_bounded_and_so_are_jobs(spark, tmp_path):
    """Ten times the stores make rounds of ten times the size, and as many Spark jobs."""
    jobs = {}
    for n in (40, 400):
        mart = spark.createDataFrame([(f"s{i:04}", f"{i} A", "X", "NJ", None, None) for i in range(n)], MART)
        table, audit = AppendTable(spark, f"file://{tmp_path}/geocodes{n}", sc.STORE_GEOCODES), AuditLog(spark, f"file://{tmp_path}/{n}")
        sizes = []

        def resolve(requests):
            sizes.append(requests.count())
            return requests.select("store_id", F.lit(reply(LONG_ZIP)).alias("body"))

        spark.sparkContext.setJobGroup(f"geocode-{n}", "")
        assert run_geocoding(mart, table, resolve, audit, rounds=4, least=5).startswith(f"pending {n}, processed {n}, geocoded {n}")
        jobs[n] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"geocode-{n}"))
        assert sizes == [n // 4] * 4
        assert table.read().select("store_id").distinct().count() == n
    spark.sparkContext._jsc.clearJobGroup()
    assert jobs[400] <= jobs[40] + 6  # adaptive execution may cut a stage more, but no job belongs to a store


def test_a_paced_service(spark):
    """Twelve calls in two tasks at 20 a second take half a second at least; a failing call is a transient reply."""
    import time

    def call(query):
        if query == "q7":
            raise OSError("gone")
        return '{"status":"ZERO_RESULTS"}'

    requests = spark.createDataFrame([(f"s{i}", f"q{i}") for i in range(12)], "store_id string, geocode_query string")
    start = time.monotonic()
    found = {r["store_id"]: r["geocode_status"] for r in gc.classify_replies(paced(call, 20, 2)(requests)).collect()}
    assert time.monotonic() - start > 0.4
    assert found == {f"s{i}": "TRANSIENT" if i == 7 else "ZERO_RESULTS" for i in range(12)}


def test_reply_files_are_whole_csv_texts_and_the_last_reply_counts(spark, tmp_path):
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "1.csv").write_text(
        '"a","1 A","Match","Exact","1 A\nST, 07009","-1,2"\n"b","x","No_Match"\n"a","1 A","Match","Exact","1 A, 07001","-1,2"\n')
    (tmp_path / "r" / "2.csv").write_text('"c","3 C","Tied","Exact","3 ""C"", 07003",""\n"b","x","Match","Exact","2 B, 07002","-1,x"\n')
    found = gc.batch_updates(read_replies(spark, f"file://{tmp_path}/r"))
    assert sorted(tuple(r) for r in found.collect()) == [
        ("a", "07001", 2.0, -1.0), ("b", "07002", None, None), ("c", "07003", None, None)]


def test_backfill_of_the_store_table_stays(spark, tmp_path):
    """Zip and coordinates survive later reads, re-scrapes without coordinates, and rewriting."""
    table = KeyedTable(spark, f"file://{tmp_path}/stores", sc.STORES_NORMALIZED, "store_id")

    def scraped(*rows):
        return spark.createDataFrame([(i, a, z, datetime(2024, 1, 1), "f") for i, a, z in rows],
                                     "store_id string, address string, zip string, ingested_at timestamp, source_file string")

    def state():
        return {r["store_id"]: (r["zip"], r["lat"], r["lng"]) for r in table.read().collect()}

    def service(requests):
        return requests.select("store_id", F.lit("Match").alias("match_flag"), F.lit("1 A ST, 07001").alias("matched_address"),
                               F.lit("-74.1,40.5").alias("coords"))

    table.upsert(scraped(("a", "1 A", None), ("b", "2 B", "07002")), "q-0")
    assert backfill_zips(table, service) == (1, 1)
    wanted = {"a": ("07001", 40.5, -74.1), "b": ("07002", None, None)}
    assert state() == wanted
    table.rewrite()
    assert state() == wanted
    table.upsert(scraped(("a", "9 Z", "07009"), ("c", "3 C", None)), "q-1")
    assert state() == {**wanted, "a": ("07009", 40.5, -74.1), "c": (None, None, None)}
    assert backfill_zips(table, service) == (1, 1)
    table.rewrite()
    assert state()["c"] == ("07001", 40.5, -74.1) and backfill_zips(table, service) == (0, 0)
