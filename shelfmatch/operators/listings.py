"""Scraped rows: all text in, typed rows with a stable identity out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.functions import parsing as ps
from shelfmatch.functions import text as tx
from shelfmatch.schemas import SCRAPE_COLUMNS, SCRAPE_TEXT, STORES_NORMALIZED, conform


def normalize_listings(raw: DataFrame, ingested_at: Column, source_file: Column,
                       keep: Sequence[str] = ()) -> DataFrame:
    """``raw`` holds scrape columns as text; a missing column counts as blank."""
    raw = raw.withColumns({name: F.lit("") for name in SCRAPE_COLUMNS if name not in raw.columns})
    typed = raw.select(
        tx.store_id(*[F.col(c) for c in ("store_name", "house_number", "road", "parsed_city", "state")])
        .alias("store_id"),
        *[ps.parse_text(F.col(name)).alias(name) for name in SCRAPE_TEXT],
        ps.parse_bool(F.col("is_chain")).alias("is_chain"), ps.parse_float(F.col("rating")).alias("rating"),
        ps.parse_int(F.col("review_count")).alias("review_count"),
        ingested_at.alias("ingested_at"), source_file.alias("source_file"), *keep)
    return conform(typed, STORES_NORMALIZED, keep)
