"""Stores without coordinates: worklists, reply parsing, the negative cache and the joins that fill locations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.functions import geo
from shelfmatch.functions.parsing import parse_float
from shelfmatch.functions.text import blank_if_null, null_if_blank, strip
from shelfmatch.operators.merge import batch_of, fill_missing, last_per_key, not_in
from shelfmatch.schemas import STORE_GEOCODES, ZIP_LOOKUP, add_missing_columns, conform

BATCH_SIZE = 9_500  # fixed value: the batch geocoder takes 10,000 rows at most


# ---- ZIP reference ----

def parse_zip_rows(raw: DataFrame) -> DataFrame:
    """Rows without usable coordinates, or with unreadable density or population, are dropped.

    A file may lack any column; one it lacks counts as blank.
    """
    raw = add_missing_columns(raw, {c: "string" for c in (
        "zip", "city", "state_id", "county_name", "lat", "lng", "density", "population")})
    typed = raw.select(
        geo.zip_code(F.col("zip")).alias("zip"), null_if_blank(F.col("city")).alias("city"),
        F.upper(null_if_blank(F.col("state_id"))).alias("state"),
        null_if_blank(F.col("county_name")).alias("county"),
        parse_float(F.col("lat")).alias("latitude"), parse_float(F.col("lng")).alias("longitude"),
        geo.number_or_zero(F.col("density")).alias("pop_density_sqmi"),
        geo.number_or_zero(F.col("population"), "int").alias("population"))
    kept = typed.dropna(subset=["latitude", "longitude", "pop_density_sqmi", "population"])
    return conform(kept.withColumn("area_type", geo.area_type(F.col("pop_density_sqmi"))), ZIP_LOOKUP)


# ---- worklists ----

def missing_coordinates(mart: DataFrame) -> DataFrame:
    return mart.filter(F.col("latitude").isNull() & F.col("address").isNotNull())


def pending_geocodes(mart: DataFrame, geocodes: DataFrame) -> DataFrame:
    """Stores without a coordinate that were never resolved, nor found unresolvable."""
    return not_in(missing_coordinates(mart), geocodes)


def geocode_requests(mart: DataFrame, geocodes: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """In key order; a limit below 1 counts as 1. Without ``geocodes`` all of ``mart`` is pending."""
    pending = mart if geocodes is None else pending_geocodes(mart, geocodes)
    requests = pending.select(
        "store_id", geo.geocode_query(*[F.col(c) for c in ("address", "parsed_city", "state", "zip")])
        .alias("geocode_query")).orderBy("store_id")
    return requests if limit is None else requests.limit(max(1, limit))


def missing_zips(stores: DataFrame) -> DataFrame:
    return stores.filter(F.col("zip").isNull() & F.col("address").isNotNull()).select(
        "store_id", "address", "parsed_city", "state")


def batch_requests(stores: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """``batch_id, store_id, line``: the batch geocoder's rows ``ID,Street,City,State,ZIP`` with the last one blank."""
    def plain(name: str) -> Column:
        return strip(F.regexp_replace(blank_if_null(F.col(name)), ",", " "))

    line = F.concat_ws(",", "store_id", plain("address"), plain("parsed_city"),
                       strip(blank_if_null(F.col("state"))), F.lit(""))
    return batch_of(stores, "store_id", size).select("batch_id", "store_id", line.alias("line"))


# ---- replies ----

def classify_replies(raw: DataFrame) -> DataFrame:
    """``store_id, body`` to ``store_id, geocode_status`` and, where ``OK``, the location of the first result."""
    parsed = raw.withColumn("reply", geo.parse_reply(F.col("body"))).withColumn(
        "geocode_status", geo.reply_status(F.col("reply")))
    first = F.when(F.col("geocode_status") == geo.OK, F.get("reply.results", F.lit(0)))
    return parsed.withColumn("result", first).select(
        "store_id", "geocode_status", F.col("result.geometry.location.lat").alias("lat"),
        F.col("result.geometry.location.lng").alias("lng"), geo.reply_zip(F.col("result")).alias("zip"),
        F.col("result.formatted_address").alias("formatted_address"),
        F.col("result.geometry.location_type").alias("location_type"))


def geocode_rows(classified: DataFrame, geocoded_at: Column) -> DataFrame:
    """Rows for the lookup table. Transient failures are left out, so they stay pending."""
    final = classified.filter(F.col("geocode_status") != geo.TRANSIENT)
    return conform(final.withColumn("geocoded_at", geocoded_at), STORE_GEOCODES)


def geocode_summary(pending: DataFrame, classified: DataFrame) -> DataFrame:
    """One row of counts over this run's replies; ``pending`` is the worklist before it."""
    status = F.col("geocode_status")
    done = classified.agg(
        F.count("*").alias("processed"), F.count_if(status == geo.OK).alias("geocoded"),
        F.count_if(status.isin(*geo.PERMANENT)).alias("unresolvable"),
        F.count_if(status == geo.TRANSIENT).alias("transient"))
    waiting = pending.agg(F.count("*").alias("n")).scalar()
    return done.select(waiting.alias("pending"), "*").withColumn(
        "remaining", F.col("pending") - F.col("geocoded") - F.col("unresolvable"))


def unresolved(geocodes: DataFrame) -> DataFrame:
    return geocodes.filter(F.col("lat").isNull()).select("store_id", "geocode_status")


def forget(geocodes: DataFrame, keys: DataFrame) -> DataFrame:
    """Cached rows of these stores go, which makes them pending again."""
    return not_in(geocodes, keys)


def batch_updates(raw: DataFrame) -> DataFrame:
    """``store_id, zip, lat, lng`` from batch replies ``store_id, match_flag, matched_address, coords``.

    Only matches and ties with a zip count. The last row of an id wins: by ``reply_order`` where the rows have it, else, and
    among equals, by zip.
    """
    order = [c for c in ("reply_order",) if c in raw.columns]
    good = raw.filter(F.upper(strip(F.col("match_flag"))).isin("MATCH", "TIED")).select(
        strip(F.col("store_id")).alias("store_id"), geo.batch_zip(F.col("matched_address")).alias("zip"),
        geo.batch_point(F.col("coords")).alias("point"), *order)
    found = good.filter(F.col("zip").isNotNull()).select("store_id", "zip", "point.lat", "point.lng", *order)
    return last_per_key(found, "store_id", [*order, "zip"]).drop(*order)


def backfill_counts(missing: DataFrame, updates: DataFrame) -> DataFrame:
    """How many of the stores without a zip got one, and how many there are."""
    found = missing.join(updates.select("store_id", F.lit(True).alias("hit")), "store_id", "left")
    return found.agg(F.count("hit").alias("matched"), F.count("*").alias("total"))


def apply_batch_updates(stores: DataFrame, updates: DataFrame) -> DataFrame:
    """The zip is taken over, a coordinate only where none is known; the columns are added if the table lacks them."""
    target = add_missing_columns(stores, {"lat": "double", "lng": "double"})
    return fill_missing(target, updates, replace=["zip"], only_null=["lat", "lng"])


# ---- locations ----

def locate_stores(stores: DataFrame, geocodes: DataFrame, zips: DataFrame) -> DataFrame:
    """Coordinates: the store's own, else geocoded, else its zip's centre. A geocoded zip brings the zip's attributes.

    ``stores`` has ``zip, lat, lng``. Zips are hot keys, so the join's strategy is left to the optimizer: the lookup is
    broadcast while its measured size allows, and skewed partitions are split otherwise. Of several geocodes of a store the
    last counts.
    """
    g = last_per_key(geocodes, "store_id", ["geocoded_at"]).select("store_id", F.col("lat").alias("g_lat"), F.col("lng").alias("g_lng"),
                        F.col("zip").alias("g_zip"))
    z = zips.select(F.col("zip").alias("full_zip"), "latitude", "longitude", "pop_density_sqmi", "area_type", "county")
    joined = stores.join(g, "store_id", "left").withColumn("full_zip", F.coalesce("zip", "g_zip")).join(
        z, "full_zip", "left")
    lat, lng = F.coalesce("lat", "g_lat", "latitude"), F.coalesce("lng", "g_lng", "longitude")
    own = [c for c in stores.columns if c not in ("zip", "lat", "lng")]
    return joined.select(
        *own, F.col("full_zip").alias("zip"), lat.alias("latitude"), lng.alias("longitude"), "pop_density_sqmi",
        "area_type", "county")
