"""Distributor accounts and candidate stores in the shape the matcher compares."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmatch.functions import text as tx

METRICS = ("case_volume", "revenue", "revenue_per_case")
STORE_COLUMNS = (
    "store_id", "brand", "store_name", "address", "phone", "email", "parsed_country", "parsed_city", "house_number",
    "road", "zip", "state", "is_chain", "chain_name", "rating", "review_count", "nj_abc_license_number",
)


def union_accounts(staging: Iterable[DataFrame]) -> DataFrame:
    """One account list from one table per distributor."""
    return reduce(lambda a, b: a.unionByName(b), staging)


def project_accounts(raw: DataFrame) -> DataFrame:
    """Eleven columns: text never null, sales figures as doubles."""
    def text(name: str, alias: str):
        return tx.blank_if_null(F.col(name).cast("string")).alias(alias)

    return raw.select(
        text("distributor", "distributor_name"), text("account_id", "source_id"),
        text("original_name", "original_name"), text("clean_name", "name"), text("clean_address", "address"),
        text("city", "city"), text("state", "state"), text("zip_code", "zip_code"),
        *[F.col(metric).cast("double").alias(metric) for metric in METRICS])


def project_candidates(stores: DataFrame) -> DataFrame:
    def text(name: str, alias: str):
        return tx.blank_if_null(F.col(name)).alias(alias)

    return stores.select(
        "store_id", text("store_name", "name"), text("address", "address"), text("parsed_city", "city"),
        text("state", "state"), text("zip", "zip_code"))


def with_match_keys(records: DataFrame) -> DataFrame:
    """Everything compared later, computed once per record."""
    return (
        records.withColumn("norm_addr", tx.norm_addr(F.concat_ws(" ", "address", "city", "state")))
        .withColumn("norm_name", tx.norm_name(F.col("name")))
        .withColumn("norm_name_key", tx.name_key(F.col("norm_name")))
        .withColumn("norm_city", tx.norm_city(F.col("city")))
        .withColumn("house_num", tx.house_num(F.col("norm_addr")))
    )


def matchable_accounts(raw: DataFrame) -> DataFrame:
    """Accounts with match keys and a total order inside each distributor.

    ``rec_ord`` follows ``source_id``; the hash only separates accounts that share one. Exact copies are one account.
    """
    accounts = project_accounts(raw)
    fingerprint = F.md5(F.to_json(F.struct(*accounts.columns)))
    return (
        with_match_keys(accounts.withColumn("rec_ord", F.concat("source_id", F.lit("\x01"), fingerprint)))
        .withColumn("state_block", F.upper("state"))
        .withColumn("addr_words", tx.sorted_words(F.col("norm_addr")))
        .withColumn("key_words", tx.sorted_words(F.col("norm_name_key")))
        .dropDuplicates(["distributor_name", "rec_ord"])
    )


def matchable_candidates(stores: DataFrame) -> DataFrame:
    return (
        with_match_keys(project_candidates(stores))
        .withColumn("state_block", F.upper("state"))
        .withColumn("addr_words", tx.sorted_words(F.col("norm_addr")))
        .withColumn("key_words", tx.sorted_words(F.col("norm_name_key")))
        .withColumn("is_cannabis", tx.is_cannabis(F.col("name")))
        .withColumn("is_city_only_name", F.size(F.array_except(
            tx.words(F.col("norm_name_key")), tx.words(F.col("norm_city")))) == 0)
    )


def records_per_distributor(accounts: DataFrame) -> DataFrame:
    return accounts.groupBy("distributor_name").agg(F.count("*").alias("records"))


def last_by_key(accounts: DataFrame, key: str, *payload: str) -> DataFrame:
    """Per distributor and key, the last account in order; blank keys have none."""
    kept = (
        accounts.filter(F.col(key) != "").groupBy("distributor_name", key)
        .agg(F.max(F.struct("rec_ord", *payload)).alias("last"))
    )
    return kept.select("distributor_name", key, "last.*")
