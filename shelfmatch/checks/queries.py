"""One query per operator, over whole derived tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch import schemas as sc
from shelfmatch.checks.fixtures import load
from shelfmatch.functions import audit as au
from shelfmatch.functions import geo
from shelfmatch.functions import parsing as ps
from shelfmatch.functions import similarity as sim
from shelfmatch.functions import text as tx
from shelfmatch.operators import accounts as ac
from shelfmatch.operators import geocoding as gc
from shelfmatch.operators import health as he
from shelfmatch.operators import listings, merge
from shelfmatch.operators import matching as ma
from shelfmatch.operators.similarity_join import similar_texts
from shelfmatch.plans import match_run
from shelfmatch.plans.geocode_run import backfill_zips, run_geocoding
from shelfmatch.plans.monitor_run import run_monitor
from shelfmatch.session import materialize, scratch_path, tune
from shelfmatch.sources.audit_log import AuditLog
from shelfmatch.sources.batch_geocoder import read_replies, write_requests
from shelfmatch.sources.scrape_files import landed_files, readable_rows, scan_files
from shelfmatch.sources.tables import AppendTable, KeyedTable, ReplacedTable
from shelfmatch.sources.zip_file import read_zip_file
from shelfmatch.streaming.file_arrival import start_ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SPLIT = "1998-06-01 00:00:00"  # earlier scrapes are a table's content, later ones the next load
NOW = datetime(2024, 1, 31, 0, 30)
c, lit = F.col, F.lit


def query(function: Callable[[Callable[[str], DataFrame]], DataFrame]) -> Query:
    """Register a query written over ``t(name)``, the derived table of that name."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        return function(lambda name: load(spark, sf_dir, name))

    QUERIES[function.__name__] = run
    return run


# ---- shared inputs ----

def typed_scrapes(t) -> DataFrame:
    return listings.normalize_listings(t("scrapes"), c("seen_at"), c("source_file"))


def earlier_stores(t) -> DataFrame:
    return merge.latest_scrape(typed_scrapes(t).filter(c("ingested_at") < lit(SPLIT).cast("timestamp")))


def later_stores(t) -> DataFrame:
    return merge.latest_scrape(typed_scrapes(t).filter(c("ingested_at") >= lit(SPLIT).cast("timestamp")))


def cached_geocodes(t) -> DataFrame:
    return gc.geocode_rows(gc.classify_replies(t("geocode_raw")), lit(NOW))


def no_geocodes(t) -> DataFrame:
    return cached_geocodes(t).filter("store_id is null")


def located(t) -> DataFrame:
    """Stores with a coordinate where the scraper knew one: those in chains."""
    known = c("is_chain")
    return t("stores").withColumns({"lat": F.when(known, lit(40.5)), "lng": F.when(known, lit(-74.5))})


def mart(t) -> DataFrame:
    return located(t).withColumnRenamed("lat", "latitude")


def universe(t) -> DataFrame:
    return ma.account_universe(ma.find_matches(t("stores"), t("accounts")), lit(NOW), F.to_date(lit(NOW)))


def flat_matches(t) -> DataFrame:
    return ma.unnest_matches(ma.find_matches(t("stores"), t("accounts")))


def match_tables(spark: SparkSession) -> tuple[KeyedTable, AuditLog]:
    root = scratch_path(spark, "match-run")
    return KeyedTable(spark, f"{root}/universe", sc.ACCOUNT_UNIVERSE, "store_id"), AuditLog(spark, root)


def match_sides(t) -> tuple[DataFrame, DataFrame]:
    return (materialize(ac.matchable_candidates(t("stores")), "candidates"),
            materialize(ac.matchable_accounts(t("accounts")), "accounts"))


def named_hits(hits: DataFrame) -> DataFrame:
    return hits.select(
        "store_id", "distributor_name", "match_layer", "match_confidence", "match_status",
        F.substring_index("rec_ord", "\x01", 1).alias("customer_id"))


def both_sides(t, store_column: str, account_column: str, function, name: str) -> DataFrame:
    stores = t("stores").select(c("store_id").alias("id"), function(c(store_column)).alias(name))
    return stores.unionByName(t("accounts").select(c("account_id").alias("id"), function(c(account_column)).alias(name)))


# ---- text functions ----

@query
def norm_addr(t):
    return t("stores").select("store_id", tx.norm_addr(F.concat_ws(" ", *[
        tx.blank_if_null(c(x)) for x in ("address", "parsed_city", "state")])).alias("norm_addr"))


@query
def norm_name(t):
    return t("accounts").select("account_id", tx.norm_name(c("clean_name")).alias("norm_name")).unionByName(
        t("stores").select(c("store_id").alias("account_id"), tx.norm_name(c("store_name")).alias("norm_name")))


@query
def name_key(t):
    return both_sides(t, "store_name", "clean_name", lambda x: tx.name_key(tx.norm_name(x)), "name_key")


@query
def cannabis_flag(t):
    return both_sides(t, "store_name", "clean_name", tx.is_cannabis, "is_cannabis")


@query
def norm_city(t):
    return both_sides(t, "parsed_city", "city", tx.norm_city, "norm_city")


@query
def house_num(t):
    """Of address, city and state in one text, as the matcher has it."""
    sides = (ac.project_candidates(t("stores")).withColumnRenamed("store_id", "id"),
             ac.project_accounts(t("accounts")).withColumnRenamed("source_id", "id"))
    return sides[0].select("id", "address", "city", "state").unionByName(sides[1].select("id", "address", "city", "state")).select(
        "id", tx.house_num(tx.norm_addr(F.concat_ws(" ", "address", "city", "state"))).alias("house_num"))


@query
def norm_id_field(t):
    return t("scrapes").select(
        "phone", tx.norm_id_field(c("store_name")).alias("name_id"), tx.norm_id_field(c("road")).alias("road_id"))


@query
def store_identity(t):
    return t("scrapes").select("phone", "seen_at", tx.store_id(
        *[c(x) for x in ("store_name", "house_number", "road", "parsed_city", "state")]).alias("store_id"))


@query
def parse_bool(t):
    return t("scrapes").select("phone", "is_chain", ps.parse_bool(c("is_chain")).alias("parsed"))


@query
def parse_float(t):
    return t("scrapes").select("phone", "rating", ps.parse_float(c("rating")).alias("parsed"))


@query
def parse_int(t):
    return t("scrapes").select("phone", "review_count", ps.parse_int(c("review_count")).alias("parsed"))


@query
def parse_text(t):
    return t("scrapes").select(*[ps.parse_text(c(x)).alias(x) for x in sc.SCRAPE_TEXT])


@query
def api_eligible(t):
    return t("stores").select("store_id", "state", tx.api_eligible(c("state")).alias("run_api"))


# ---- similarity ----

@query
def similarity_ratio(t):
    """Each store name against its own brand and address."""
    name = F.lower(c("store_name"))
    return t("stores").select(
        "store_id", sim.ratio(name, F.lower(c("brand"))).alias("name_to_brand"),
        sim.ratio(name, F.lower(tx.blank_if_null(c("address")))).alias("name_to_address"))


@query
def similarity_of_long_texts(t):
    """Texts longer than a machine word on both sides."""
    def joined(*names):
        return F.lower(F.concat_ws(" ", *names))

    a = joined("store_name", "brand", "address", "parsed_city", "state", "phone", "road", "parsed_country", "zip")
    b = joined("phone", "brand", "road", "store_name", "address", "parsed_city", "store_name", "brand", "address", "state",
               "store_name", "road", "phone")
    return t("stores").select("store_id", F.char_length(a).cast("long").alias("left_length"),
                              F.char_length(b).cast("long").alias("right_length"), sim.ratio(a, b).alias("score"))


@query
def token_sort_ratio(t):
    name, brand = tx.sorted_words(F.lower(c("store_name"))), tx.sorted_words(F.lower(c("brand")))
    return t("stores").select("store_id", sim.ratio(name, brand).alias("score"))


@query
def similar_city_pairs(t):
    """City spellings of stores and accounts close enough to be one place."""
    def cities(df, name):
        return df.select(F.struct(tx.blank_if_null(c("state")).alias("state")).alias("block"),
                         tx.norm_city(c(name)).alias("text")).filter("text <> ''").distinct()

    pairs = similar_texts(cities(t("stores"), "parsed_city"), cities(t("accounts"), "city"), ma.SAME_CITY)
    return pairs.select("block.state", c("left_text").alias("store_city"), c("right_text").alias("account_city"),
                        "score")


@query
def similar_names_in_tiles(t):
    """Similarity join of names in a state, every block cut into small units and tiles."""
    def names(df, name):
        return df.select(F.struct(tx.blank_if_null(c("state")).alias("state")).alias("block"),
                         tx.norm_name(c(name)).alias("text")).distinct()

    pairs = similar_texts(names(t("stores"), "store_name"), names(t("accounts"), "clean_name"), ma.FLAGGED, unit=64, tile=16)
    return pairs.select("block.state", c("left_text").alias("store_text"), c("right_text").alias("account_text"),
                        "score")


# ---- accounts and candidates ----

@query
def account_projection(t):
    return ac.project_accounts(t("accounts"))


@query
def candidate_projection(t):
    return ac.project_candidates(t("stores"))


@query
def matcher_input_scan(t):
    return t("stores").select(*ac.STORE_COLUMNS)


@query
def records_per_distributor(t):
    return ac.records_per_distributor(ac.project_accounts(t("accounts")))


@query
def union_distributors(t):
    accounts = t("accounts")
    staged = [accounts.filter(c("distributor") == name) for name in ("north_dist", "south_dist")]
    return ac.union_accounts(staged).select("distributor", "account_id", "clean_name")


@query
def last_account_per_name(t):
    last = ac.last_by_key(ac.matchable_accounts(t("accounts")), "norm_name")
    return last.select("distributor_name", "norm_name", F.substring_index("rec_ord", "\x01", 1).alias("source_id"))


@query
def stores_with_licences(t):
    return merge.matcher_input(t("stores").drop("nj_abc_license_number"), t("licences")).select(*ac.STORE_COLUMNS)


# ---- match layers ----

@query
def match_exact_address(t):
    return named_hits(ma.match_exact_address(*match_sides(t)))


@query
def match_exact_name(t):
    return named_hits(ma.match_exact_name(*match_sides(t)))


@query
def match_fuzzy_zip(t):
    return named_hits(ma.match_fuzzy(*match_sides(t), layers=(ma.FUZZY_ZIP,)))


@query
def match_fuzzy_city(t):
    return named_hits(ma.match_fuzzy(*match_sides(t), layers=(ma.FUZZY_CITY,)))


@query
def match_fuzzy_name_or_address(t):
    return named_hits(ma.match_fuzzy(*match_sides(t), layers=(ma.FUZZY_NAME, ma.FUZZY_ADDRESS)))


@query
def match_fuzzy_state(t):
    """City, name and address layers together: the first confirmed account in bucket order, else the best flagged."""
    return named_hits(ma.match_fuzzy(*match_sides(t), layers=(ma.FUZZY_CITY, ma.FUZZY_NAME, ma.FUZZY_ADDRESS)))


@query
def match_wide_block(t):
    """All stores and accounts in one state without a city: blocks of many units, each of many tiles, thinned in the tasks."""
    stores = t("stores").withColumns({"state": lit("NJ"), "parsed_city": lit(None).cast("string")})
    accounts = t("accounts").withColumns({"state": lit("NJ"), "city": lit(None).cast("string")})
    sides = (materialize(ac.matchable_candidates(stores), "candidates"), materialize(ac.matchable_accounts(accounts), "accounts"))
    return named_hits(ma.match_fuzzy(*sides, layers=(ma.FUZZY_NAME, ma.FUZZY_ADDRESS), unit=256, tile=64))


@query
def state_buckets(t):
    """Accounts a store's state bucket holds: its own state's first, then those without a state."""
    candidates, accounts = match_sides(t)
    sizes = accounts.groupBy("distributor_name", c("state_block").alias("area")).agg(F.count("*").alias("accounts"))
    return ma.with_areas(candidates).join(sizes, "area").select(
        "store_id", "distributor_name", "own_state", "accounts")


@query
def match_cascade(t):
    return flat_matches(t)


@query
def distributor_match_arrays(t):
    nested = ma.find_matches(t("stores"), t("accounts"))
    return nested.select(
        "store_id", F.size("distributor_matches").cast("long").alias("entries"),
        F.array_join(F.transform("distributor_matches", lambda m: m["distributor_name"]), ",").alias("distributors"),
        ma.any_match(c("distributor_matches")).alias("any_distributor_match"))


@query
def account_universe(t):
    """All 24 columns, one row per entry of the nested array."""
    whole = universe(t)
    return whole.select(*[x for x in whole.columns if x != "distributor_matches"], F.inline("distributor_matches"))


@query
def matched_with_revenue(t):
    return flat_matches(t).filter(c("matched") & c("revenue").isNotNull()).select(
        "store_id", "distributor_name", "case_volume", "revenue", "revenue_per_case")


@query
def match_rollup(t):
    return he.match_rollup(flat_matches(t)).withColumn("mean_confidence", F.round("mean_confidence", 6)).withColumn(
        "revenue", F.round("revenue", 2))


@query
def match_counts(t):
    return he.match_counts(universe(t))


@query
def zero_match_check(t):
    """Against a broken account load, of which only the blank rows are left, nothing can match."""
    broken = t("accounts").withColumns({
        name: lit("") for name in ("clean_name", "clean_address", "city", "state", "zip_code")})
    return he.zero_match_violation(he.match_counts(
        ma.account_universe(ma.find_matches(t("stores"), broken), lit(NOW), F.to_date(lit(NOW)))))


# ---- merges and incremental runs ----

@query
def incremental_stores(t):
    return match_run.stores_to_match(t("stores"), t("stores").filter("is_chain"), "incremental").select("store_id")


@query
def stores_to_process_count(t):
    todo = match_run.stores_to_match(t("stores"), t("stores").filter("is_chain"), "incremental")
    return match_run.count_stores(todo)


@query
def incremental_match(t):
    """Two runs: the second adds the stores the first, over chains, left out; the first one's rows keep their stamps."""
    stores, accounts = t("stores"), t("accounts")
    table, audit = match_tables(stores.sparkSession)
    match_run.run_matching(stores.filter("is_chain"), accounts, table, audit, now=datetime(2024, 1, 1))
    match_run.run_matching(stores, accounts, table, audit, now=NOW)
    return table.read().select("store_id", "any_distributor_match", "matched_at", "run_date")


@query
def full_match_run(t):
    """A full run over non-chains replaces what a run over chains had left; it leaves a heartbeat with its rows."""
    stores, accounts = t("stores"), t("accounts")
    table, audit = match_tables(stores.sparkSession)
    match_run.run_matching(stores.filter("is_chain"), accounts, table, audit, now=datetime(2024, 1, 1))
    match_run.run_matching(stores.filter("not is_chain"), accounts, table, audit, "full", NOW)
    beat = audit.runs.read().filter("mode = 'full'").agg(F.max("rows_processed")).scalar()
    return table.read().select("store_id", "any_distributor_match", "matched_at", beat.alias("rows_processed"))


@query
def normalized_listings(t):
    return typed_scrapes(t)


@query
def latest_scrape(t):
    return merge.latest_scrape(typed_scrapes(t))


@query
def last_row_per_store(t):
    return merge.last_per_key(typed_scrapes(t), "store_id", ["source_file"])


@query
def upsert(t):
    return merge.upsert(earlier_stores(t), later_stores(t))


@query
def insert_only_merge(t):
    return merge.insert_new(earlier_stores(t), later_stores(t))


@query
def full_sync_merge(t):
    return merge.full_sync(earlier_stores(t), later_stores(t))


@query
def full_sync_empty_source(t):
    return merge.full_sync(earlier_stores(t), later_stores(t).filter(c("state") == "no such state"))


@query
def fill_missing_merge(t):
    stores = t("stores").select("store_id", "address", "zip").withColumns(
        {"lat": F.when(c("address").isNull(), lit(1.5)), "lng": lit(None).cast("double")})
    return gc.apply_batch_updates(stores, gc.batch_updates(t("census_raw")))


@query
def additive_columns(t):
    typed = sc.add_missing_columns(
        t("scrapes").select("phone", "store_name", "rating"), {"rating": "double", "nj_abc_license_number": "string"})
    return typed.unionByName(t("licences").select(c("licence_number").alias("nj_abc_license_number")),
                             allowMissingColumns=True)


# ---- zips and geocodes ----

@query
def zip_lookup(t):
    return gc.parse_zip_rows(t("zip_raw"))


@query
def zip_file_load(t):
    """The reference file written as CSV, loaded, and replaced in its table."""
    raw = t("zip_raw")
    path = scratch_path(raw.sparkSession, "zip-file")
    raw.write.option("header", "true").option("escape", '"').option("ignoreLeadingWhiteSpace", "false").csv(path)
    table = ReplacedTable(raw.sparkSession, scratch_path(raw.sparkSession, "zip-table"), sc.ZIP_LOOKUP)
    table.replace(read_zip_file(raw.sparkSession, path))
    return table.read()


@query
def zip_file_without_density(t):
    """The same file without its optional columns."""
    raw = t("zip_raw").select("zip", "lat", "lng")
    path = scratch_path(raw.sparkSession, "zip-file")
    raw.write.option("header", "true").csv(path)
    return read_zip_file(raw.sparkSession, path)


@query
def area_type(t):
    rows = t("zip_raw").withColumn("d", geo.number_or_zero(c("density")))
    return rows.select("zip", geo.area_type(c("d")).alias("area_type"))


@query
def missing_coordinates(t):
    return gc.missing_coordinates(mart(t)).select("store_id")


@query
def pending_geocode_requests(t):
    return gc.geocode_requests(mart(t), cached_geocodes(t))


@query
def first_geocode_requests(t):
    return gc.geocode_requests(mart(t), cached_geocodes(t), limit=25)


@query
def pending_geocode_count(t):
    return gc.pending_geocodes(mart(t), cached_geocodes(t)).agg(F.count("*").alias("pending"))


@query
def reply_zip(t):
    replies = t("geocode_raw").select("store_id", geo.parse_reply(c("body")).alias("r"))
    return replies.select("store_id", geo.reply_zip(F.get("r.results", lit(0))).alias("zip"))


@query
def classified_replies(t):
    return gc.classify_replies(t("geocode_raw"))


@query
def geocode_sink(t):
    """Replies appended to the lookup table, negative ones included, transient ones not."""
    rows = cached_geocodes(t)
    table = AppendTable(rows.sparkSession, scratch_path(rows.sparkSession, "geocodes"), sc.STORE_GEOCODES)
    table.append(rows)
    return table.read()


@query
def resumed_geocoding(t):
    """What a second run would still ask for after a first one, in rounds, stored its replies."""
    stores, known = mart(t), t("geocode_raw")
    spark, root = stores.sparkSession, scratch_path(stores.sparkSession, "geocode-run")
    table = AppendTable(spark, f"{root}/geocodes", sc.STORE_GEOCODES)
    run_geocoding(stores, table, lambda requests: known.join(requests, "store_id", "left_semi"), AuditLog(spark, root))
    return gc.geocode_requests(stores, table.read())


@query
def failure_capture(t):
    """A run whose service breaks in every task leaves an error row, no heartbeat, and all stores as pending as before."""
    stores = mart(t)
    spark, root = stores.sparkSession, scratch_path(stores.sparkSession, "failed-run")
    table, audit = AppendTable(spark, f"{root}/geocodes", sc.STORE_GEOCODES), AuditLog(spark, root)
    try:
        run_geocoding(stores, table, lambda requests: requests.select(
            "store_id", F.raise_error(F.concat(lit("no service for "), c("store_id"))).cast("string").alias("body")), audit)
        raised = False
    except Exception:
        raised = True
    pending = gc.pending_geocodes(stores, table.read()).agg(F.count("*")).scalar()
    return audit.errors.read().select(
        "component", "check_name", "test_type", "severity", "context", c("message").contains("no service for").alias("told"),
        lit(raised).alias("raised"), lit(audit.runs.read().isEmpty()).alias("no_heartbeat"), pending.alias("pending"))


@query
def geocode_summary(t):
    pending = gc.pending_geocodes(mart(t), no_geocodes(t))
    replies = t("geocode_raw").join(pending, "store_id", "left_semi")
    return gc.geocode_summary(pending, gc.classify_replies(replies))


@query
def unresolved_geocodes(t):
    return gc.unresolved(cached_geocodes(t))


@query
def forgotten_geocodes(t):
    return gc.forget(cached_geocodes(t), t("licences").select("store_id").dropna()).select("store_id", "geocode_status")


@query
def located_stores(t):
    return gc.locate_stores(
        located(t).select("store_id", "zip", "lat", "lng"), cached_geocodes(t), gc.parse_zip_rows(t("zip_raw")))


@query
def missing_zip_worklist(t):
    return gc.missing_zips(t("stores")).orderBy("store_id")


@query
def batch_request_lines(t):
    return gc.batch_requests(gc.missing_zips(t("stores")), size=100)


@query
def batch_request_files(t):
    """Request lines written to one folder per batch and read back without their headers."""
    lines = gc.batch_requests(t("stores"), size=100)
    path = scratch_path(lines.sparkSession, "batch-requests")
    write_requests(lines, path)
    back = lines.sparkSession.read.option("header", "true").option("sep", "\x01").option("quote", "").schema(
        "line string, batch_id long").csv(path)
    return back.select("batch_id", "line")


@query
def batch_reply_zip(t):
    return t("census_raw").select("store_id", geo.batch_zip(c("matched_address")).alias("zip"))


@query
def batch_reply_point(t):
    return t("census_raw").select("store_id", geo.batch_point(c("coords")).alias("p")).select("store_id", "p.lat",
                                                                                              "p.lng")


@query
def batch_reply_lines(t):
    """Replies as the service sends them: matches have eight fields, misses three."""
    quoted = [F.concat(lit('"'), c(x), lit('"')) for x in ("store_id", "matched_address", "match_flag")]
    miss = F.concat_ws(",", *quoted)
    full = F.concat_ws(",", *quoted, lit('"Exact"'), quoted[1], F.concat(lit('"'), c("coords"), lit('"')), lit('"1"'),
                       lit('"L"'))
    raw = t("census_raw")
    lines = raw.select(F.when(c("match_flag") == "No_Match", miss).otherwise(full).alias("value"))
    # Every id comes in an earlier file too, with another zip: the last reply counts.
    early = raw.withColumn("matched_address", lit("1 FIRST ST, TOWN, NJ, 00001")).select(full.alias("value"))
    path = scratch_path(raw.sparkSession, "replies")
    early.write.text(f"{path}/1")
    lines.write.text(f"{path}/2")
    replies = read_replies(raw.sparkSession, f"{path}/*")
    return gc.batch_updates(replies.filter(c("match_flag") != "No_Match"))


@query
def backfill_counts(t):
    return gc.backfill_counts(gc.missing_zips(t("stores")), gc.batch_updates(t("census_raw")))


# ---- files and streams ----

def land_scrapes(rows: DataFrame, bucket: str, name: str, separator: str, columns: tuple[str, ...]) -> None:
    rows.select(*columns).write.option("header", "true").option("sep", separator).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(
        f"{bucket}/normalized/{name}")


def land_spaced(rows: DataFrame, bucket: str, name: str) -> None:
    """Comma files with a space after every comma."""
    lines = rows.select(F.concat_ws(", ", *[F.trim(c(x)) for x in sc.SCRAPE_COLUMNS]).alias(", ".join(sc.SCRAPE_COLUMNS)))
    lines.write.option("header", "true").option("sep", "\x01").option("quote", "").csv(f"{bucket}/normalized/{name}")


def land_in_order(rows: DataFrame, bucket: str, name: str) -> None:
    """All rows, repeated stores included; later rows in later files, so that their order is the scrapes' own."""
    order = ["seen_at", "source_file", *SCRAPE_ORDER]
    land_scrapes(rows.repartitionByRange(*order).sortWithinPartitions(*order), bucket, name, ",", sc.SCRAPE_COLUMNS)


SCRAPE_ORDER = ("brand", "store_name", "address", "phone", "email", "parsed_country", "parsed_city", "house_number", "road",
                "zip", "state", "is_chain", "chain_name", "rating", "review_count")


@query
def scrape_file_scan(t):
    """Four layouts (comma; tab in another order; a space after each comma; a header of over 4,096 characters), and a file
    outside the landing folder."""
    raw = t("scrapes").drop("source_file")
    spark, bucket = raw.sparkSession, scratch_path(raw.sparkSession, "bucket")
    season = F.month("seen_at") % 4
    land_scrapes(raw.filter(season == 0), bucket, "comma", ",", sc.SCRAPE_COLUMNS)
    land_scrapes(raw.filter(season == 1), bucket, "tab", "\t", sc.SCRAPE_COLUMNS[::-1])
    land_spaced(raw.filter(season == 2), bucket, "spaced")
    wide = {f"column_that_nobody_knows_{i}": lit("x") for i in range(180)}
    land_scrapes(raw.filter(season == 3).withColumns(wide), bucket, "wide", ",", (*wide, *sc.SCRAPE_COLUMNS))
    land_scrapes(raw, f"{bucket}/elsewhere", "comma", ",", sc.SCRAPE_COLUMNS)
    # Spark names the files: a name stands for the folder that Spark itself finds it in.
    folders = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(bucket).select(
        F.element_at(F.split("path", "/"), -1).alias("source_file"), F.element_at(F.split("path", "/"), -2).alias("folder"))
    rows = listings.normalize_listings(readable_rows(scan_files(landed_files(spark, bucket))), lit(NOW), c("source_file"))
    # A row a file. The scan's rows would be broadcast instead: Spark takes them for as few as the ranges they are read from.
    return rows.join(F.broadcast(folders), "source_file").withColumn("source_file", c("folder")).select(sc.STORES_NORMALIZED.names)


@query
def scrape_ingest_stream(t):
    """Two arrivals read by one checkpointed stream; the second updates and adds stores; a third run finds nothing."""
    raw = t("scrapes")
    spark, root = raw.sparkSession, scratch_path(raw.sparkSession, "stream")
    early = c("seen_at") < lit(SPLIT).cast("timestamp")
    table = KeyedTable(spark, f"{root}/stores_normalized", sc.STORES_NORMALIZED, "store_id")
    for name, rows in (("first", raw.filter(early)), ("second", raw.filter(~early))):
        land_in_order(rows, f"{root}/bucket", name)
        start_ingest(spark, f"{root}/bucket", table, f"{root}/checkpoint").awaitTermination()
    start_ingest(spark, f"{root}/bucket", table, f"{root}/checkpoint").awaitTermination()
    table.rewrite()
    return table.read().drop("ingested_at", "source_file")


def batch_service(requests: DataFrame) -> DataFrame:
    """Answers made of the store's id: no match for one in four, a zip and one point for the rest."""
    digits = F.translate("store_id", "abcdef", "123456")
    return requests.select(
        "store_id", F.when(F.substring("store_id", 1, 1).isin("0", "1", "2", "3"), "No_Match").otherwise("Match").alias("match_flag"),
        F.concat(lit("1 A ST, TOWN, NJ, "), F.substring(digits, 2, 5)).alias("matched_address"), lit("-74.5,40.25").alias("coords"))


def ingested_and_backfilled(t) -> tuple[DataFrame, KeyedTable, str]:
    raw = t("scrapes")
    spark, root = raw.sparkSession, scratch_path(raw.sparkSession, "backfill")
    table = KeyedTable(spark, f"{root}/stores_normalized", sc.STORES_NORMALIZED, "store_id")
    land_in_order(raw.filter(c("seen_at") < lit(SPLIT).cast("timestamp")), f"{root}/one", "files")
    start_ingest(spark, f"{root}/one", table, f"{root}/checkpoint-one").awaitTermination()
    backfill_zips(table, batch_service)
    return raw, table, root


@query
def ingest_then_backfill(t):
    _, table, _ = ingested_and_backfilled(t)
    return table.read().select("store_id", "address", "zip", "lat", "lng")


@query
def ingest_after_compaction(t):
    """Ingest, backfill, one load in place of many, then a stream with a new checkpoint over a new bucket: nothing is lost."""
    raw, table, root = ingested_and_backfilled(t)
    table.rewrite()
    land_in_order(raw.filter(c("seen_at") >= lit(SPLIT).cast("timestamp")), f"{root}/two", "files")
    start_ingest(raw.sparkSession, f"{root}/two", table, f"{root}/checkpoint-two").awaitTermination()
    return table.read().select("store_id", "address", "zip", "lat", "lng", "rating")


@query
def staged_snapshot(t):
    rows = later_stores(t)
    table = KeyedTable(rows.sparkSession, scratch_path(rows.sparkSession, "staged"), sc.STORES_NORMALIZED, "store_id")
    table.replace(earlier_stores(t))
    table.replace(rows)
    return table.read()


# ---- health ----

@query
def last_success(t):
    return he.last_success(t("runs"))


@query
def run_ages(t):
    runs = t("runs")
    checks = runs.select("component").distinct().withColumn("max_age_hours", lit(he.MAX_AGE_HOURS))
    unseen = checks.withColumn("component", F.concat("component", lit("_nightly")))
    return he.run_ages(checks.unionByName(unseen), runs, lit(NOW))


@query
def freshness_check(t):
    runs = t("runs")
    checks = runs.select("component").distinct().withColumn("max_age_hours", lit(he.MAX_AGE_HOURS))
    unseen = checks.withColumn("component", F.concat("component", lit("_nightly")))
    return he.freshness_violations(checks.unionByName(unseen), runs, lit(NOW)).drop("message")


@query
def monitor_run(t):
    """Problems that a monitor run writes to the error log."""
    runs = t("runs")
    audit = AuditLog(runs.sparkSession, scratch_path(runs.sparkSession, "monitor"))
    audit.runs.append(runs)
    watched = [(r["component"], he.MAX_AGE_HOURS) for r in runs.select("component").distinct().collect()]
    run_monitor(audit, lit(NOW), (*watched, ("job_unheard_of", he.MAX_AGE_HOURS)))
    return audit.errors.read().select("component", "check_name", "test_type", "context")


@query
def elapsed_hours(t):
    return t("runs").select("run_id", au.elapsed_hours(c("finished_at"), lit(NOW)).alias("age_hours"))


@query
def run_stamps(t):
    return t("runs").select("run_id", au.run_stamp(c("finished_at")).alias("stamp"),
                            F.to_date("finished_at").alias("run_date"))


@query
def recent_errors(t):
    return he.recent_errors(t("errors"), lit(NOW))


@query
def error_window_assertion(t):
    return he.error_window_violations(t("errors"), lit(NOW), 48).select("error_id", "occurred_at", "component")


@query
def error_log_sink(t):
    """Errors appended by day, and one window of them read back."""
    rows = t("errors")
    table = AppendTable(rows.sparkSession, scratch_path(rows.sparkSession, "errors"), sc.PIPELINE_ERRORS, "occurred_at")
    table.append(rows)
    return table.read(since=datetime(2024, 1, 20)).select("error_id", "occurred_at", "severity", "context")


@query
def run_log_sink(t):
    rows = t("runs")
    table = AppendTable(rows.sparkSession, scratch_path(rows.sparkSession, "runs"), sc.PIPELINE_RUNS, "finished_at")
    table.append(rows)
    return table.read()


@query
def account_contract(t):
    """Accounts written in two schemas: one distributor's files lack a column and have another as text."""
    accounts = t("accounts").withColumns({name: c(name).cast("double") for name in ac.METRICS})
    spark, root = accounts.sparkSession, scratch_path(accounts.sparkSession, "accounts")
    north = c("distributor") == "north_dist"
    accounts.filter(north).write.parquet(f"{root}/north")
    accounts.filter(~north).drop("revenue").withColumn("case_volume", c("case_volume").cast("string")).write.parquet(f"{root}/south")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    return he.contract_violations(files, sc.DISTRIBUTOR_ACCOUNTS).drop("files")


@query
def key_violations(t):
    return he.key_violations(typed_scrapes(t), "store_id")


@query
def null_violations(t):
    """Required columns of a load that lost some of their values."""
    broken = typed_scrapes(t).withColumns({
        "ingested_at": F.when(c("rating").isNotNull(), c("ingested_at")), "source_file": F.when(c("zip").isNotNull(), c("source_file"))})
    return he.null_violations(broken, sc.required_columns(sc.STORES_NORMALIZED))


@query
def error_context_json(t):
    """Structured context of each run as JSON text."""
    return t("runs").select("run_id", au.context_json(c("component"), c("rows_processed"), c("mode")).alias("context"))


@query
def hex_ids(t):
    """Random ids: their form, and how many there are."""
    ids = materialize(t("runs").select("run_id", au.hex_id().alias("id")), "ids")
    return ids.select("run_id", F.char_length("id").alias("length"), c("id").rlike("^[0-9a-f]+$").alias("is_hex"),
                      ids.agg(F.count_distinct("id")).scalar().alias("different"))
