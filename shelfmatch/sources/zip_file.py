"""The ZIP reference file: a header CSV whose extra columns are ignored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfmatch.operators.geocoding import parse_zip_rows
from shelfmatch.schemas import ZIP_LOOKUP
from shelfmatch.sources.tables import ReplacedTable


def read_zip_file(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"', encoding="UTF-8")
    return parse_zip_rows(raw)


def load_zip_lookup(spark: SparkSession, path: str, root: str) -> None:
    ReplacedTable(spark, root, ZIP_LOOKUP).replace(read_zip_file(spark, path))
