"""Files exchanged with the batch geocoder: requests out, replies in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REQUEST_HEADER = "ID,Street,City,State,ZIP"  # fixed value: the service expects it
_REPLY = "id string, input string, match_flag string, match_kind string, matched_address string, coords string"


def write_requests(lines: DataFrame, path: str) -> None:
    """``batch_id, store_id, line`` to one folder per batch; every file starts with the header."""
    ordered = lines.repartition("batch_id").sortWithinPartitions("batch_id", "store_id")
    ordered.select("batch_id", F.col("line").alias(REQUEST_HEADER)).write.partitionBy("batch_id").option(
        "header", "true").option("quote", "").option("sep", "\x01").csv(path)


def parse_reply_lines(lines: DataFrame) -> DataFrame:
    """Reply rows ``store_id, match_flag, matched_address, coords`` from text ``value``; short rows are dropped."""
    # No field equals this null mark, so only a field that is not there is null.
    fields = F.from_csv("value", F.lit(_REPLY), {"nullValue": "\x00", "escape": '"', "mode": "PERMISSIVE"})
    return lines.select(fields.alias("f")).filter(F.col("f.coords").isNotNull()).select(
        F.col("f.id").alias("store_id"), "f.match_flag", "f.matched_address", "f.coords")


def read_replies(spark: SparkSession, path: str) -> DataFrame:
    """Reply files as one CSV text each, quoted line ends included, with ``reply_order``: by file, then by row."""
    rows = spark.read.csv(path, schema=_REPLY, multiLine=True, quote='"', escape='"', nullValue="\x00", emptyValue="")
    order = F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row"))
    return rows.withColumn("reply_order", order).filter(F.col("coords").isNotNull()).select(
        F.col("id").alias("store_id"), "match_flag", "matched_address", "coords", "reply_order")
