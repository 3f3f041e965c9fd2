"""Each scrape file that lands is read once and upserted into the store table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfmatch.session import materialize, scratch_released, tune
from shelfmatch.sources.audit_log import AuditLog
from shelfmatch.sources.scrape_files import LANDING, readable_rows, scan_files, stores_and_problems, unreadable_files
from shelfmatch.sources.tables import KeyedTable

COMPONENT = "scrape-ingest"
#: Files of one micro-batch; their names are what a scan needs on the driver.
FILES_PER_TRIGGER = 1000


def ingest(files: DataFrame, stores: KeyedTable, mark: tuple[str, int] | None = None, audit: AuditLog | None = None) -> None:
    """``files``: ``path, length``. Files are read once; a batch is one load of the table, named by its ``mark``.

    A file that can't be read becomes an error row with its name (without an audit log, an exception); all others go in.
    """
    def run() -> None:
        found = materialize(stores_and_problems(scan_files(files), F.current_timestamp()), "scrapes")
        bad = unreadable_files(found)
        if not bad.isEmpty():
            if audit is None:
                raise ValueError(f"unreadable: {bad.first()['path']}")
            audit.log_violations(
                bad.select(F.lit(COMPONENT).alias("component"), F.lit("unreadable_file").alias("check_name"),
                           F.col("problem").alias("message"), "path"),
                test_type="infrastructure", context=F.to_json(F.struct(F.col("path").alias("file"))))
        stores.upsert(readable_rows(found), "-".join(map(str, mark)) if mark else None)

    with scratch_released(stores.spark):
        if audit is None:
            run()
        else:
            with audit.recording(COMPONENT, {"batch": -1 if mark is None else mark[1]}):
                run()


def arriving_files(spark: SparkSession, bucket: str, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """A stream of ``path, length``: names only, so tracking files costs no reading of them."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").option(
        "maxFilesPerTrigger", files_per_trigger).load(f"{bucket}/{LANDING}").select("path", "length")


def start_ingest(spark: SparkSession, bucket: str, stores: KeyedTable, checkpoint: str,
                 audit: AuditLog | None = None, once: bool = True, files_per_trigger: int = FILES_PER_TRIGGER) -> StreamingQuery:
    """``once``: read everything that has landed, then stop; else keep watching.

    A batch that is replayed writes its own load again. Loads carry the stream's id, which a new checkpoint renews.
    """
    tune(spark)

    def batch(files: DataFrame, number: int) -> None:
        stream = files.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        ingest(files, stores, (stream, number) if stream else None, audit)

    writer = arriving_files(spark, bucket, files_per_trigger).writeStream.option(
        "checkpointLocation", checkpoint).foreachBatch(batch)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()
