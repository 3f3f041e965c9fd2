"""Merges as plain joins: the result is the target's next snapshot.

Keys are required columns, so ``left_anti`` is the right difference; it also shuffles like any equi join, where a
null-aware ``NOT IN`` would copy one side to every executor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmatch.session import materialize


def not_in(df: DataFrame, known: DataFrame, key: str = "store_id") -> DataFrame:
    return df.join(known.select(key), key, "left_anti")


def upsert(target: DataFrame, source: DataFrame, key: str = "store_id") -> DataFrame:
    """Source rows replace target rows of the same key. ``source`` has one row per key, see ``last_per_key``."""
    return source.select(target.columns).unionByName(not_in(target, source, key).select(target.columns))


def insert_new(target: DataFrame, source: DataFrame, key: str = "store_id") -> DataFrame:
    """Rows already in the target stay untouched."""
    return target.unionByName(not_in(source, target, key).select(target.columns))


def full_sync(target: DataFrame, source: DataFrame) -> DataFrame:
    """Every column is taken from the source and absent rows go, so the source is the result.

    An empty source means a broken load, not an empty universe: the target stays.
    """
    return target if source.isEmpty() else source.select(target.columns)


def fill_missing(target: DataFrame, updates: DataFrame, replace: Sequence[str], only_null: Sequence[str],
                 key: str = "store_id") -> DataFrame:
    """Matched rows: ``replace`` columns taken over, ``only_null`` columns filled. Nothing is inserted."""
    fresh = updates.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in (*replace, *only_null)])
    joined = target.join(fresh, key, "left")
    values: dict[str, Column] = {c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in replace}
    values |= {c: F.coalesce(c, f"_new_{c}") for c in only_null}
    return joined.withColumns(values).select(target.columns)


def last_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key, the greatest by ``order`` and then by the whole row; nulls are least.

    A row number of which only the first is asked for: each task keeps one row of a key before the shuffle (a group limit),
    so a hot key is no larger there than others, and rows that are already dealt out by key are not dealt out again.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    number = F.row_number().over(Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in (*order, *rest)]))
    return df.withColumn("_number", number).filter("_number = 1").drop("_number")


def latest_scrape(stores: DataFrame) -> DataFrame:
    return last_per_key(stores, "store_id", ["ingested_at", "source_file"])


def matcher_input(stores: DataFrame, licences: DataFrame) -> DataFrame:
    """Latest store rows with their licence number, and licences without a store under synthetic ids.

    ``licences``: one row per licence, ``licence_number, store_id, licensee, city, state``; at most one per store is
    kept, the greatest number.
    """
    linked = licences.filter(F.col("store_id").isNotNull()).groupBy("store_id").agg(
        F.max("licence_number").alias("nj_abc_license_number"))
    orphans = licences.join(stores.select("store_id"), "store_id", "left_anti").select(
        F.concat(F.lit("nj-abc:"), "licence_number").alias("store_id"),
        F.col("licensee").alias("store_name"), F.col("city").alias("parsed_city"), "state",
        F.col("licence_number").alias("nj_abc_license_number"))
    return stores.join(linked, "store_id", "left").unionByName(orphans, allowMissingColumns=True)


def batch_of(df: DataFrame, key: str, size: int) -> DataFrame:
    """``batch_id`` of every row: fixed-size runs in key order.

    A global row number would sort all rows in one task. Here each range partition numbers its own rows, and only the
    partitions' counts, one row each, are added up.
    """
    ranged = materialize(
        df.repartitionByRange(F.col(key)).withColumn("_part", F.spark_partition_id())
        .sortWithinPartitions(key), "ranged")
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = counts.select("_part", F.coalesce(
        F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(key)) - 1
    return ranged.withColumn("_inside", inside).join(before, "_part").withColumn(
        "batch_id", F.floor((F.col("_before") + F.col("_inside")) / size)).drop("_part", "_before", "_inside")
