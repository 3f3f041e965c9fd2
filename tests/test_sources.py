import io
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shelfmatch.schemas import STORES_NORMALIZED, ZIP_LOOKUP
from shelfmatch.sources.audit_log import AuditLog
from shelfmatch.sources import scrape_files
from shelfmatch.sources.scrape_files import landed_files, known_columns, ranges, read_scrapes, readable_rows, records, scan_files, sniff_dialect
from shelfmatch.sources.tables import KeyedTable, ReplacedTable
from shelfmatch.sources.zip_file import load_zip_lookup
from shelfmatch.streaming.file_arrival import ingest, start_ingest

HEADER = "brand,store_name,address,phone,email,parsed_country,parsed_city,house_number,road,zip,state,is_chain," \
         "chain_name,rating,review_count\n"
ROW = "B,{name},10 Main St,1,a@b,US,Newark,10,Main St,07001,NJ,true,,{rating},142\n"


@pytest.fixture
def bucket(tmp_path):
    (tmp_path / "normalized" / "deep").mkdir(parents=True)
    return tmp_path


def read(spark, bucket):
    return read_scrapes(landed_files(spark, f"file://{bucket}"), F.lit(datetime(2024, 1, 1)))


@pytest.mark.parametrize("sample, dialect, header", [
    ("a,b\n1,2\n", (",", '"', False), ["a", "b"]), ("a\tb\n1\t2\n", ("\t", '"', False), ["a", "b"]),
    ('"x, y"\tb\n1\t2\n3\t4\n', ("\t", '"', False), ["x, y", "b"]), ("single\n", (",", '"', False), ["single"]),
    ("", (",", '"', False), []), ("a, b, c\n1, 2, 3\n4, 5, 6\n", (",", '"', True), ["a", "b", "c"]),
    ('a,"b\nc"\n1,2\n', (",", '"', False), ["a", "b\nc"])])
def test_dialect_and_header(sample, dialect, header):
    assert sniff_dialect(sample) == dialect
    assert next(records(io.StringIO(sample, newline=""), dialect), []) == header


def test_only_known_columns_make_a_layout():
    assert known_columns(["note", "state", "x", "state", "zip", "more"]) == ["", "", "", "state", "zip"]


def test_files_of_several_layouts(spark, bucket):
    folder = bucket / "normalized"
    (folder / "a.csv").write_text(HEADER + ROW.format(name="Joe's", rating="4.5"))
    (folder / "deep" / "b.csv").write_text(
        'state\tstore_name\tnote\taddress\nNJ\t"Two\nLines ""q"""\tx\t 1, A St \n\nPA\tShort\n')
    (folder / "empty.csv").write_text("")
    (folder / ".keep").write_text("")
    (folder / "header_only.csv").write_text(HEADER)
    (bucket / "raw.csv").write_text(HEADER + ROW.format(name="Outside", rating="1"))
    rows = {r["store_name"]: r for r in read(spark, bucket).collect()}
    assert set(rows) == {"Joe's", 'Two\nLines "q"', "Short"}
    joe, two, short = rows["Joe's"], rows['Two\nLines "q"'], rows["Short"]
    assert (joe["rating"], joe["review_count"], joe["is_chain"], joe["chain_name"]) == (4.5, 142, True, None)
    assert (joe["source_file"], joe["ingested_at"]) == ("a.csv", datetime(2024, 1, 1))
    assert (two["address"], two["is_chain"], two["rating"], two["source_file"]) == ("1, A St", False, None, "b.csv")
    assert (short["address"], short["state"]) == (None, "PA")
    assert len(joe["store_id"]) == 32


def test_last_row_of_a_file_wins_then_the_last_file(spark, bucket):
    many = "".join(ROW.format(name=f"S{i % 50}", rating=i) for i in range(5000))
    (bucket / "normalized" / "a.csv").write_text(HEADER + many)
    (bucket / "normalized" / "b.csv").write_text(HEADER + ROW.format(name="S7", rating="-1"))
    rows = {r["store_name"]: r["rating"] for r in read(spark, bucket).collect()}
    assert rows == {**{f"S{i}": 4950.0 + i for i in range(50)}, "S7": -1.0}


def test_nothing_to_read(spark, bucket):
    (bucket / "normalized" / "empty.csv").write_text("")
    assert scan_files(landed_files(spark, f"file://{bucket}")).isEmpty()


def test_repeated_column_means_its_last(spark, bucket):
    (bucket / "normalized" / "a.csv").write_text("store_name,state,store_name\nfirst,NJ,second\nx,PA,y\n")
    assert sorted(r["store_name"] for r in read(spark, bucket).collect()) == ["second", "y"]


def test_stream_reads_each_file_once(spark, bucket, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/stores", STORES_NORMALIZED, "store_id")

    def run():
        query = start_ingest(spark, f"file://{bucket}", table, f"file://{tmp_path}/checkpoint")
        query.awaitTermination()
        return {r["store_name"]: r["rating"] for r in table.read().collect()}

    (bucket / "normalized" / "a.csv").write_text(HEADER + ROW.format(name="A", rating="1") + ROW.format(name="B", rating="1"))
    assert run() == {"A": 1.0, "B": 1.0}
    (bucket / "normalized" / "b.csv").write_text(HEADER + ROW.format(name="B", rating="2") + ROW.format(name="C", rating="2"))
    assert run() == {"A": 1.0, "B": 2.0, "C": 2.0}
    first = {r["store_name"]: r["ingested_at"] for r in table.read().collect()}
    run()
    assert {r["store_name"]: r["ingested_at"] for r in table.read().collect()} == first


def test_spaces_after_commas_and_very_long_headers(spark, bucket):
    folder = bucket / "normalized"
    (folder / "spaces.csv").write_text('store_name, state, zip\nSpaced, NJ, 07001\n"Quo, ted", PA, "0, 7"\nThird, NY, 1\n')
    wide = ",".join(f"unknown_column_{i}" for i in range(900))
    (folder / "wide.csv").write_text(f"store_name,{wide},zip\nWide,{',' * 899},07009\n")
    rows = {r["store_name"]: (r["state"], r["zip"]) for r in read(spark, bucket).collect()}
    assert rows == {"Spaced": ("NJ", "07001"), "Quo, ted": ("PA", "0, 7"), "Third": ("NY", "1"), "Wide": (None, "07009")}


@pytest.mark.parametrize("size", [7, 64, 1000])
def test_any_range_begins_at_a_record(spark, bucket, monkeypatch, size):
    """Files cut anywhere, in quoted fields with line ends, doubled quotes and wide letters: each record once, in order."""
    monkeypatch.setattr(scrape_files, "RANGE", size)
    names = [f"S{i} " + ("plain", 'a "q" b', "two\nlines", "é✓", 'end"\n', "", ",", '5" pipe')[i % 8] for i in range(60)]
    stray = {i for i, n in enumerate(names) if n.endswith("pipe")}  # a quote character that is none, in a field without quotes
    quoted = ['"' + n.replace('"', '""') + '"' if i not in stray and (i % 2 or set(n) & set('",\n')) else n for i, n in enumerate(names)]
    text = "state,store_name,zip\r\n" + "".join(f"NJ,{q},{i}\r\n" + "\n" * (i % 11 == 0) for i, q in enumerate(quoted))
    (bucket / "normalized" / "a.csv").write_text(text, newline="")
    (bucket / "normalized" / "b.csv").write_text("store_name\nlast", newline="")
    files = landed_files(spark, f"file://{bucket}")
    assert ranges(files).count() == -(-len(text.encode()) // size) + -(-15 // size)
    rows = readable_rows(scan_files(files)).orderBy("source_file", "part_start", "row_order").collect()
    assert [r["store_name"] for r in rows] == [*names, "last"]
    assert [r["zip"] for r in rows] == [*map(str, range(60)), ""]


def test_ranges_are_read_by_many_tasks(spark, bucket, monkeypatch):
    """Ranges are tiny rows, which adaptive execution hands to one task unless told how many there are."""
    monkeypatch.setattr(scrape_files, "RANGE", 400)
    for name in ("a", "b"):
        (bucket / "normalized" / f"{name}.csv").write_text(HEADER + "".join(ROW.format(name=f"{name}{i}", rating=i) for i in range(100)))
    for i in range(30):
        (bucket / "normalized" / f"small{i}.csv").write_text(HEADER + ROW.format(name=f"s{i}", rating=i))
    rows = scan_files(landed_files(spark, f"file://{bucket}")).withColumn("task", F.spark_partition_id())
    small = F.col("source_file").startswith("small")
    tasks = {r["small"]: r["tasks"] for r in rows.groupBy(small.alias("small")).agg(F.countDistinct("task").alias("tasks")).collect()}
    assert tasks[True] > 8 and tasks[False] > 8


def test_stores_and_problems(spark, bucket):
    """A row per store, and every problem beside them."""
    (bucket / "normalized" / "a.csv").write_text(HEADER + "".join(ROW.format(name=f"S{i % 5}", rating=i) for i in range(3000)))
    (bucket / "normalized" / "bad.csv").write_bytes(b"\xff\xfe\x00")
    found = scrape_files.stores_and_problems(scan_files(landed_files(spark, f"file://{bucket}")), F.lit(datetime(2024, 1, 1)))
    rows = found.collect()
    assert sorted((r["store_name"], r["rating"]) for r in rows if not r["problem"]) == [(f"S{i}", 2995.0 + i) for i in range(5)]
    assert [r["path"].rpartition("/")[2] for r in rows if r["problem"]] == ["bad.csv"]


def test_ingest_writes_one_row_per_store_between_reading_and_loading(spark, bucket, tmp_path, monkeypatch):
    from shelfmatch.streaming import file_arrival

    (bucket / "normalized" / "a.csv").write_text(HEADER + "".join(ROW.format(name=f"S{i % 5}", rating=i) for i in range(300)))
    written, write = [], file_arrival.materialize
    monkeypatch.setattr(file_arrival, "materialize", lambda df, name: written.append(write(df, name)) or written[-1])
    counts = []
    table = KeyedTable(spark, f"file://{tmp_path}/stores", STORES_NORMALIZED, "store_id")
    upsert = table.upsert
    monkeypatch.setattr(table, "upsert", lambda df, load: (counts.append(written[0].count()), upsert(df, load)))
    ingest(landed_files(spark, f"file://{bucket}"), table)
    assert counts == [5] and table.read().count() == 5


def test_replayed_batch_changes_nothing(spark, bucket, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/stores", STORES_NORMALIZED, "store_id")
    (bucket / "normalized" / "a.csv").write_text(HEADER + ROW.format(name="A", rating="1"))
    files = landed_files(spark, f"file://{bucket}")
    for _ in range(2):
        ingest(files, table, ("stream", 0))
    assert table.read().count() == 1 and len(list((tmp_path / "stores").glob("snapshot=*/load=*"))) == 1


def test_a_new_checkpoint_after_a_rewrite_still_ingests(spark, bucket, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/stores", STORES_NORMALIZED, "store_id")

    def run(checkpoint):
        start_ingest(spark, f"file://{bucket}", table, f"file://{tmp_path}/{checkpoint}", files_per_trigger=1).awaitTermination()
        return {r["store_name"]: r["rating"] for r in table.read().collect()}

    for name in "abc":
        (bucket / "normalized" / f"{name}.csv").write_text(HEADER + ROW.format(name=name, rating="1"))
    assert run("one") == {"a": 1.0, "b": 1.0, "c": 1.0}
    table.rewrite()
    (bucket / "normalized" / "d.csv").write_text(HEADER + ROW.format(name="d", rating="2"))
    assert run("two") == {"a": 1.0, "b": 1.0, "c": 1.0, "d": 2.0}


def test_a_bad_file_becomes_an_error_row_and_the_others_go_in(spark, bucket, tmp_path):
    audit = AuditLog(spark, f"file://{tmp_path}")
    table = KeyedTable(spark, f"file://{tmp_path}/stores", STORES_NORMALIZED, "store_id")
    (bucket / "normalized" / "good.csv").write_text(HEADER + ROW.format(name="A", rating="1"))
    (bucket / "normalized" / "bad.csv").write_bytes(b"store_name,state\n\xff\xfe\xff,NJ\n")
    listed = landed_files(spark, f"file://{bucket}").unionAll(
        spark.createDataFrame([(f"file://{tmp_path}/none.csv", 5)], "path string, length long"))
    ingest(listed, table, ("s", 3), audit)
    assert [r["store_name"] for r in table.read().collect()] == ["A"]
    errors = sorted((r["check_name"], r["context"].rpartition("/")[2]) for r in audit.errors.read().collect())
    assert errors == [("unreadable_file", 'bad.csv"}'), ("unreadable_file", 'none.csv"}')]
    with pytest.raises(ValueError):
        ingest(listed, table)


def test_failed_ingest_is_recorded_and_raised(spark, bucket, tmp_path, monkeypatch):
    audit = AuditLog(spark, f"file://{tmp_path}")
    table = KeyedTable(spark, f"file://{tmp_path}/stores", STORES_NORMALIZED, "store_id")
    (bucket / "normalized" / "a.csv").write_text(HEADER + ROW.format(name="A", rating="1"))

    def fail(*_):
        raise OSError("disk")

    monkeypatch.setattr(table, "upsert", fail)
    with pytest.raises(OSError):
        ingest(landed_files(spark, f"file://{bucket}"), table, ("s", 3), audit)
    row = audit.errors.read().first()
    assert (row["component"], row["check_name"], row["test_type"], row["context"]) == (
        "scrape-ingest", "unhandled_exception", "infrastructure", '{"batch":3}')


def test_audit_rows(spark, tmp_path):
    audit = AuditLog(spark, f"file://{tmp_path}")
    assert audit.log_error("job", "check", "text", context={"n": 1, "s": "x"}, run_id="r")
    assert audit.log_run("job", mode="full", rows=7) and audit.log_run("job", run_id="mine")
    error = audit.errors.read().first()
    assert (error["severity"], error["context"], error["run_id"], len(error["error_id"])) == (
        "ERROR", '{"n":1,"s":"x"}', "r", 32)
    runs = {r["run_id"] == "mine": r for r in audit.runs.read().collect()}
    assert (runs[False]["rows_processed"], runs[False]["status"], runs[True]["mode"]) == (7, "success", None)


def test_audit_never_raises(spark, tmp_path):
    (tmp_path / "pipeline_errors").write_text("a file where a folder belongs")
    assert AuditLog(spark, f"file://{tmp_path}").log_error("job", "check", "text") is False


def test_zip_file(spark, tmp_path):
    (tmp_path / "zips.csv").write_text(
        '"zip","lat","lng","city","state_id","zcta","population","density","county_name"\n'
        '"501","40.8","-73.0","Holtsville","ny","x","100.9","","Suffolk"\n"10001","40.7","-73.9","New York","NY","x","1",'
        '"10000",""\n"07001","bad","-74","A","nj","x","1","1","B"\n"123456","1","2","","","x","","999.5","C"\n'
        '"9","1","2","","","x","1","dense","C"\n')
    load_zip_lookup(spark, f"file://{tmp_path}/zips.csv", f"file://{tmp_path}/table")
    table = ReplacedTable(spark, f"file://{tmp_path}/table", ZIP_LOOKUP)
    assert sorted(tuple(r) for r in table.read().collect()) == [
        ("00501", "Holtsville", "NY", "Suffolk", 40.8, -73.0, 0.0, 100, "rural"),
        ("10001", "New York", "NY", None, 40.7, -73.9, 10000.0, 1, "urban"),
        ("123456", None, None, "C", 1.0, 2.0, 999.5, 0, "rural")]


def test_zip_file_without_optional_columns(spark, tmp_path):
    (tmp_path / "zips.csv").write_text("zip,lat,lng\n501,40.8,-73.0\n")
    load_zip_lookup(spark, f"file://{tmp_path}/zips.csv", f"file://{tmp_path}/table")
    table = ReplacedTable(spark, f"file://{tmp_path}/table", ZIP_LOOKUP)
    assert [tuple(r) for r in table.read().collect()] == [("00501", None, None, None, 40.8, -73.0, 0.0, 0, "rural")]
