"""Columns for ZIP reference rows and geocoder replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmatch.functions.parsing import parse_float, parse_int
from shelfmatch.functions.text import blank_if_null, strip

# Reply layout, permanent failures and density limits.
REPLY = (
    "status string, error_message string, results array<struct<"
    "geometry: struct<location: struct<lat: double, lng: double>, location_type: string>, formatted_address: string, "
    "address_components: array<struct<types: array<string>, short_name: string>>>>"
)
PERMANENT = ("ZERO_RESULTS", "INVALID_REQUEST")
OK, TRANSIENT = "OK", "TRANSIENT"
URBAN, SUBURBAN = 10_000, 1_000


def area_type(density: Column) -> Column:
    return F.when(density >= URBAN, "urban").when(density >= SUBURBAN, "suburban").otherwise("rural")


def zip_code(value: Column) -> Column:
    text = strip(value)
    return F.when(F.char_length(text) < 5, F.lpad(text, 5, "0")).otherwise(text)


def number_or_zero(value: Column, kind: str = "float") -> Column:
    """Blank is 0; other text that is no number is null."""
    parse = parse_float if kind == "float" else parse_int
    return F.when(blank_if_null(value) == "", F.lit(0).cast("double" if kind == "float" else "long")).otherwise(
        parse(value))


def parse_reply(body: Column) -> Column:
    return F.from_json(body, REPLY)


def reply_zip(result: Column) -> Column:
    """First component typed as a postal code, five characters."""
    component = F.get(F.filter(
        result["address_components"], lambda c: F.coalesce(F.array_contains(c["types"], "postal_code"), F.lit(False))),
        F.lit(0))
    return F.nullif(F.substring(component["short_name"], 1, 5), F.lit(""))


def reply_status(reply: Column) -> Column:
    """``OK``, one of the permanent failures, or ``TRANSIENT``: an unreadable reply, or one that is OK without a place."""
    place = F.get(reply["results"], F.lit(0))["geometry"]["location"]
    placed = place["lat"].isNotNull() & place["lng"].isNotNull()
    return F.when((reply["status"] == OK) & placed, F.lit(OK)).when(
        reply["status"].isin(*PERMANENT), reply["status"]).otherwise(TRANSIENT)


def geocode_query(*parts: Column) -> Column:
    """Nulls are skipped, blanks kept."""
    return F.concat_ws(", ", *parts)


def batch_zip(matched_address: Column) -> Column:
    """Last comma segment that holds a stand-alone run of five digits: the first such run in it."""
    found = F.transform(
        F.reverse(F.split(matched_address, ",")), lambda s: F.regexp_extract(s, r"(?U)\b(\d{5})\b", 1))
    return F.get(F.filter(found, lambda z: z != ""), F.lit(0))


def batch_point(coords: Column) -> Column:
    """``lon,lat`` text as a struct; both null unless both parse."""
    parts = F.split(strip(coords), ",", 2)
    lng, lat = parse_float(F.get(parts, F.lit(0))), parse_float(F.get(parts, F.lit(1)))
    both = lng.isNotNull() & lat.isNotNull()
    return F.struct(F.when(both, lat).alias("lat"), F.when(both, lng).alias("lng"))
