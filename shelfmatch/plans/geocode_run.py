"""Geocode run: requests for pending stores, their replies into the lookup table; and the bulk zip backfill."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmatch.operators import geocoding as gc
from shelfmatch.operators.merge import batch_of
from shelfmatch.session import keep_until_released, materialize, scratch_path, scratch_released, tune
from shelfmatch.sources.audit_log import AuditLog
from shelfmatch.sources.tables import AppendTable, KeyedTable, read_folder

COMPONENT = "store-geocoding"
Resolver = Callable[[DataFrame], DataFrame]


#: Rounds of a run at most, and requests of a round at least. What a failing run can lose is a round.
ROUNDS, LEAST_ROUND = 10, 1000


def paced(call: Callable[[str], str | None], per_second: float, tasks: int) -> Resolver:
    """A resolver that asks a service in ``tasks`` tasks at once, all together ``per_second`` times a second at most.

    ``call`` maps a query to a reply's text. A call that fails is a reply without a text, which counts as transient.
    """
    gap, shape = tasks / per_second, pa.schema([("store_id", pa.string()), ("body", pa.string())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        due = time.monotonic()
        for batch in batches:
            bodies = []
            for query in batch.column("geocode_query").to_pylist():
                time.sleep(max(0.0, due - time.monotonic()))
                due = max(due, time.monotonic()) + gap
                try:
                    bodies.append(call(query))
                except Exception:
                    bodies.append(None)
            yield pa.RecordBatch.from_arrays([batch.column("store_id").cast(pa.string()), pa.array(bodies, pa.string())], schema=shape)

    return lambda requests: requests.select("store_id", "geocode_query").repartition(tasks).mapInArrow(ask, "store_id string, body string")


def summary_text(row) -> str:
    return ", ".join(f"{name} {row[name]}" for name in (
        "pending", "processed", "geocoded", "unresolvable", "transient", "remaining"))


def run_geocoding(mart: DataFrame, table: AppendTable, resolve: Resolver, audit: AuditLog,
                  limit: int | None = None, rounds: int = ROUNDS, least: int = LEAST_ROUND) -> str:
    """``resolve`` turns requests ``store_id, geocode_query`` into raw replies ``store_id, body``, in as many tasks as it likes.

    Requests go out in rounds in key order, a bounded number however many stores there are, and the replies of each are
    stored before the next one goes: a run that fails keeps what was answered. A rerun asks only for stores without a stored
    reply, so it goes on where the last one stopped.
    """
    spark = tune(audit.spark)
    with audit.recording(COMPONENT), scratch_released(spark):
        asked, replied = (scratch_path(spark, name) for name in ("requests", "replies"))
        keep_until_released(spark, asked)
        keep_until_released(spark, replied)
        pending, open_stores = materialize(gc.pending_geocodes(mart, table.read()), "pending"), Observation()
        requests = materialize(gc.geocode_requests(pending, limit=limit).observe(open_stores, F.count("*").alias("n")), "requests")
        size = max(least, math.ceil(open_stores.get["n"] / rounds))
        batch_of(requests, "store_id", size).write.partitionBy("batch_id").parquet(asked)
        for number in range(math.ceil(open_stores.get["n"] / size)):
            own = spark.read.schema(requests.schema).parquet(f"{asked}/batch_id={number}")
            folder = f"{replied}/round={number}"
            resolve(own).select("store_id", "body").write.mode("overwrite").parquet(folder)
            table.append(gc.geocode_rows(gc.classify_replies(spark.read.parquet(folder)), F.current_timestamp()))
        replies = read_folder(spark, replied, T.StructType.fromDDL("store_id string, body string"))
        summary = summary_text(gc.geocode_summary(pending, gc.classify_replies(replies)).first())
    audit.log_run(COMPONENT)
    return summary


def backfill_zips(table: KeyedTable, resolve_batches: Resolver) -> tuple[int, int]:
    """``resolve_batches`` turns batch request lines into reply rows, see ``sources.batch_geocoder``.

    Only rows that change are written. Returns how many of the stores without a zip got one, and how many there were.
    """
    spark = tune(table.spark)
    table.add_columns({"lat": "double", "lng": "double"})
    stores = table.read()
    with scratch_released(spark):
        asked, answered = Observation(), Observation()
        missing = materialize(gc.missing_zips(stores).observe(asked, F.count("*").alias("total")), "missing-zips")
        updates = gc.batch_updates(resolve_batches(gc.batch_requests(missing))).join(
            missing.select("store_id", F.lit(True).alias("asked")), "store_id", "left")
        # Counted where they are written, not read again for it.
        updates = materialize(updates.observe(answered, F.count("asked").alias("matched"), F.count("*").alias("rows")), "updates")
        if answered.get["rows"]:
            changed = stores.join(updates.select("store_id"), "store_id", "left_semi")
            table.upsert(gc.apply_batch_updates(changed, updates.drop("asked")))
    return answered.get["matched"], asked.get["total"]
