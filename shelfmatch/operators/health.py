"""Run health and data quality: each check returns the rows that violate it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from shelfmatch.functions.audit import elapsed_hours
from shelfmatch.session import open_filesystem

MAX_AGE_HOURS = 26  # fixed value: one missed daily run of slack


def last_success(runs: DataFrame) -> DataFrame:
    return runs.filter(F.col("status") == "success").groupBy("component").agg(
        F.max("finished_at").alias("last_finished_at"))


def run_ages(checks: DataFrame, runs: DataFrame, now: Column) -> DataFrame:
    """``checks``: ``component, max_age_hours``. Components that never ran keep a null age."""
    return checks.join(last_success(runs), "component", "left").select(
        "component", "max_age_hours", "last_finished_at", elapsed_hours(F.col("last_finished_at"), now)
        .alias("age_hours"))


def stale_components(ages: DataFrame) -> DataFrame:
    """A null age means no run on record; whole hours past the limit mean a stale one."""
    age, limit, component = F.col("age_hours"), F.col("max_age_hours"), F.col("component")
    # The names of the checks are part of the results.
    check = F.when(age.isNull(), "no_successful_run").when(age > limit, "stale_run")
    message = F.when(age.isNull(), F.format_string("%s: never finished", component)).otherwise(
        F.format_string("%s: %d of at most %d hours since it finished", component, age, limit))
    return ages.withColumn("check_name", check).filter(F.col("check_name").isNotNull()).select(
        "component", "check_name", "age_hours", "max_age_hours", message.alias("message"))


def freshness_violations(checks: DataFrame, runs: DataFrame, now: Column) -> DataFrame:
    return stale_components(run_ages(checks, runs, now))


def recent_errors(errors: DataFrame, now: Column, hours: int = 24, limit: int = 50) -> DataFrame:
    """The last errors; of equal times those that come first by component, check, severity and message."""
    since = now - F.make_interval(hours=F.lit(hours))
    rest = ("component", "check_name", "severity", "message")
    return errors.filter(F.col("occurred_at") >= since).select("occurred_at", *rest).orderBy(
        F.col("occurred_at").desc(), *rest).limit(limit)


def error_window_violations(errors: DataFrame, now: Column, hours: int) -> DataFrame:
    """Errors inside the window; empty again once none happen."""
    since = now - F.make_interval(hours=F.lit(hours))
    return errors.filter((F.col("severity") == "ERROR") & (F.col("occurred_at") >= since))


def counters() -> list[Column]:
    """Processed and matched stores: of a table, or observed on a write."""
    return [F.count("*").alias("processed"), F.count_if("any_distributor_match").alias("matched")]


def match_counts(universe: DataFrame) -> DataFrame:
    return universe.agg(*counters())


def zero_match_violation(counts: DataFrame) -> DataFrame:
    """One row if stores were processed and none matched, which means an empty or broken account load."""
    return counts.filter((F.col("processed") > 0) & (F.col("matched") == 0))


def match_rollup(flat_matches: DataFrame) -> DataFrame:
    return flat_matches.filter("matched").groupBy("distributor_name", "match_layer", "match_status").agg(
        F.count("*").alias("stores"), F.avg("match_confidence").alias("mean_confidence"),
        F.sum("revenue").alias("revenue"))


def file_columns(files: DataFrame) -> DataFrame:
    """``path, rows, have`` (column name to Spark type) of every Parquet file of ``path``; footers are read in the tasks."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for path in batch["path"]:
                store, local = open_filesystem(path)
                with store.open_input_file(local) as file:
                    footer = pq.ParquetFile(file)
                    kinds = {f.name: from_arrow_type(f.type).simpleString() for f in footer.schema_arrow}
                    found.append((path, footer.metadata.num_rows, kinds))
            yield pd.DataFrame(found, columns=["path", "rows", "have"])

    return files.select("path").repartition("path").mapInPandas(read, "path string, rows long, have map<string, string>")


def contract_violations(files: DataFrame, required: T.StructType) -> DataFrame:
    """Declared columns that some files of a table lack or type differently, with the files and rows concerned.

    A table's files may have been written in several schemas, so one file's schema says nothing about the others.
    """
    declared = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("expected")) for f in required])
    told = file_columns(files).select("rows", "have", F.inline(declared)).withColumn("found", F.try_element_at("have", F.col("column_name")))
    kind = F.when(F.col("found").isNull(), "missing_column").when(F.col("found") != F.col("expected"), "wrong_type")
    return told.withColumn("violation", kind).filter("violation is not null").groupBy("column_name", "violation", "expected", "found").agg(
        F.count("*").alias("files"), F.sum("rows").alias("rows"))


def key_violations(df: DataFrame, key: str) -> DataFrame:
    """Keys used more than once, and the null key."""
    return df.groupBy(F.col(key).alias("key_value")).agg(F.count("*").alias("rows")).filter(
        (F.col("rows") > 1) | F.col("key_value").isNull())


def null_violations(df: DataFrame, required: Sequence[str]) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in required]))).filter("nulls > 0")
