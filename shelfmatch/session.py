"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import logging
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where the next step could have reused its partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


log = logging.getLogger(__name__)

_written: ContextVar[list[str] | None] = ContextVar("written", default=None)
#: Intermediate tables that no ``scratch_released`` block will delete, and how to delete each.
_unreleased: dict[str, Callable[[], object]] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Set the options results depend on (UTC) and those adaptive execution needs; keep sizing to the cluster."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster executors could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    root = "file://" + tempfile.mkdtemp(prefix="shelfmatch-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def open_filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path for reading the first bytes of a file inside a task, where Spark's own readers can't be called."""
    return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))


def deleter(spark: SparkSession, path: str) -> Callable[[], object]:
    """Deletes a folder by the file system that Spark itself uses for it, if it is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return lambda: files.delete(where, True)


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a glob pattern matches; for patterns that match few."""
    where = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    files = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return [entry.getPath().toString() for entry in files.globStatus(where) or []]


def delete_folder(spark: SparkSession, path: str) -> None:
    deleter(spark, path)()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result once and read it back: short lineage that outlives lost executors.

    Inside ``scratch_released`` it is deleted at the block's end, else when the program ends: what an operator returns may
    be read until then.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    keep_until_released(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def keep_until_released(spark: SparkSession, path: str) -> None:
    """Have a scratch folder deleted as an intermediate table is."""
    if (written := _written.get()) is not None:
        written.append(path)
    else:
        _unreleased[path] = deleter(spark, path)


@atexit.register
def _release() -> None:
    for delete in _unreleased.values():
        try:
            delete()
        except Exception:  # the session, and with it the way to the files, may be gone
            return


@contextmanager
def scratch_released(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are deleted on leaving; nothing inside may be read later."""
    token = _written.set([])
    try:
        yield
    finally:
        for path in _written.get():
            try:
                delete_folder(spark, path)
            except Exception:
                log.exception("intermediate table not deleted: %s", path)
        _written.reset(token)
