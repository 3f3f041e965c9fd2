"""Declared table schemas. Reads use these; nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _B, _D, _L, _TS, _DT = (
    T.StringType(), T.BooleanType(), T.DoubleType(), T.LongType(), T.TimestampType(), T.DateType())


def _table(required: str, **columns: T.DataType) -> T.StructType:
    names = required.split()
    return T.StructType([T.StructField(name, kind, name not in names) for name, kind in columns.items()])


STORES_NORMALIZED = _table(
    "store_id ingested_at source_file",
    store_id=_S, brand=_S, store_name=_S, address=_S, phone=_S, email=_S, parsed_country=_S, parsed_city=_S,
    house_number=_S, road=_S, zip=_S, state=_S, is_chain=_B, chain_name=_S, rating=_D, review_count=_L,
    ingested_at=_TS, source_file=_S)

DISTRIBUTOR_MATCH = _table(
    "", distributor_name=_S, matched=_B, customer_id=_S, customer_name=_S, match_layer=_S, match_confidence=_D,
    match_status=_S, case_volume=_D, revenue=_D, revenue_per_case=_D)

ACCOUNT_UNIVERSE = _table(
    "store_id",
    store_id=_S, brand=_S, store_name=_S, chain_name=_S, is_chain=_B, address=_S, house_number=_S, road=_S,
    parsed_city=_S, state=_S, zip=_S, parsed_country=_S, nj_abc_license_number=_S, phone=_S, email=_S, rating=_D,
    review_count=_L, distributor_matches=T.ArrayType(DISTRIBUTOR_MATCH), any_distributor_match=_B, place_id=_S,
    lat=_D, lng=_D, matched_at=_TS, run_date=_DT)

MATCHER_INPUT = _table(
    "store_id",
    store_id=_S, brand=_S, store_name=_S, address=_S, phone=_S, email=_S, parsed_country=_S, parsed_city=_S,
    house_number=_S, road=_S, zip=_S, state=_S, is_chain=_B, chain_name=_S, rating=_D, review_count=_L,
    nj_abc_license_number=_S)

DISTRIBUTOR_ACCOUNTS = _table(
    "distributor account_id",
    distributor=_S, account_id=_S, original_name=_S, clean_name=_S, clean_address=_S, city=_S, state=_S, zip_code=_S,
    case_volume=_D, revenue=_D, revenue_per_case=_D)

STORE_GEOCODES = _table(
    "store_id",
    store_id=_S, lat=_D, lng=_D, zip=_S, formatted_address=_S, location_type=_S, geocode_status=_S, geocoded_at=_TS)

ZIP_LOOKUP = _table(
    "zip", zip=_S, city=_S, state=_S, county=_S, latitude=_D, longitude=_D, pop_density_sqmi=_D, population=_L,
    area_type=_S)

PIPELINE_ERRORS = _table(
    "error_id occurred_at component check_name severity",
    error_id=_S, occurred_at=_TS, component=_S, test_type=_S, check_name=_S, severity=_S, message=_S, context=_S,
    run_id=_S)

PIPELINE_RUNS = _table(
    "run_id component status finished_at",
    run_id=_S, component=_S, mode=_S, status=_S, rows_processed=_L, finished_at=_TS)

TABLES = {
    "stores_normalized": STORES_NORMALIZED, "account_universe": ACCOUNT_UNIVERSE,
    "store_geocodes": STORE_GEOCODES, "zip_lookup": ZIP_LOOKUP, "pipeline_errors": PIPELINE_ERRORS,
    "pipeline_runs": PIPELINE_RUNS,
}
KEYS = {
    "stores_normalized": "store_id", "account_universe": "store_id", "zip_lookup": "zip",
    "pipeline_errors": "error_id", "pipeline_runs": "run_id",
}

# Text columns of a scrape file, and all of its columns.
SCRAPE_TEXT = (
    "brand", "store_name", "address", "phone", "email", "parsed_country", "parsed_city", "house_number", "road", "zip",
    "state", "chain_name")
SCRAPE_COLUMNS = SCRAPE_TEXT + ("is_chain", "rating", "review_count")


def conform(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Columns in declared order and type; missing ones are null, unknown ones go."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema], *keep)


def add_missing_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Additive evolution: a column already there stays as it is."""
    return df.withColumns({
        name: F.lit(None).cast(kind) for name, kind in columns.items() if name not in df.columns})


def required_columns(schema: T.StructType) -> list[str]:
    return [field.name for field in schema if not field.nullable]
