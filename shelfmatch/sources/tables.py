"""Parquet tables that change, as plain folders that any Parquet reader can read.

A keyed table lies in ``snapshot=<n>/load=<name>`` folders, bucketed by its key. A load writes its own folder and nothing else:
written again, as a replayed batch is, it overwrites itself. Reading takes the last row of each key in the last snapshot.
A new snapshot is written whole beside the old one and is the last from then on. One writer at a time.
"""

from __future__ import annotations

import hashlib
import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmatch.operators.merge import last_per_key, not_in
from shelfmatch.schemas import conform
from shelfmatch.session import delete_folder, matching_paths

#: Buckets of a table; a table must always be opened with as many as it was first written with.
BUCKETS = 16
_WRITTEN, _SNAPSHOT, _LOAD = "written_at", "snapshot", "load"


def read_folder(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The data below ``path``, or no rows before anything was written there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class KeyedTable:
    """One row per key. A join or aggregation by the key reads the buckets as they are: only the other side is shuffled.

    Columns beyond the declared ones can be added; a load without them leaves what a key has there as it is.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str, buckets: int = BUCKETS):
        self.spark, self.root, self.declared, self.key, self.buckets = spark, root.rstrip("/"), schema, key, buckets
        self._added: dict[str, str] | None = None

    # ---- columns ----

    def _known(self) -> dict[str, str]:
        """Added columns, as far as files have them."""
        if self._added is None:
            self._added = {}
            if self._last_snapshot() >= 0:
                whole = self.spark.read.option("mergeSchema", "true").parquet(self.root).schema
                own = {*self.declared.names, _WRITTEN, _SNAPSHOT, _LOAD}
                self._added = {f.name: f.dataType.simpleString() for f in whole if f.name not in own}
        return self._added

    @property
    def schema(self) -> T.StructType:
        return T.StructType([*self.declared, *[T.StructField(n, T.DataType.fromDDL(k)) for n, k in self._known().items()]])

    def add_columns(self, columns: dict[str, str]) -> None:
        """Additive evolution: what is there stays, rows written before have null."""
        self._known().update({n: k for n, k in columns.items() if n not in self.schema.names})

    # ---- reading ----

    def _last_snapshot(self) -> int:
        """-1 before anything was written. What is still being written doesn't count."""
        done = matching_paths(self.spark, f"{self.root}/{_SNAPSHOT}=*/{_LOAD}=*/_SUCCESS")
        return max((int(path.split("/")[-3].partition("=")[2]) for path in done), default=-1)

    def _loads(self) -> DataFrame:
        """All rows of the last snapshot, bucketed by key."""
        snapshot = self._last_snapshot()
        stored = T.StructType([*[T.StructField(f.name, f.dataType) for f in self.schema], T.StructField(_WRITTEN, T.TimestampType())])
        if snapshot < 0:
            return self.spark.createDataFrame([], T.StructType([*stored, T.StructField(_LOAD, T.StringType())]))
        # The catalog entry is but a note of where the files are and how they are bucketed.
        ddl = T.StructType([*stored, T.StructField(_SNAPSHOT, T.LongType()), T.StructField(_LOAD, T.StringType())]).toDDL()
        name = "keyed_" + hashlib.md5(f"{self.root}|{self.buckets}|{ddl}".encode()).hexdigest()
        self.spark.sql(f"create table if not exists {name} ({ddl}) using parquet partitioned by ({_SNAPSHOT}, {_LOAD}) "
                       f"clustered by ({self.key}) into {self.buckets} buckets location '{self.root}'")
        self.spark.sql(f"msck repair table {name} sync partitions")
        return self.spark.table(name).filter(F.col(_SNAPSHOT) == snapshot).drop(_SNAPSHOT)

    def keys(self) -> DataFrame:
        """The key of every row, some more than once: enough for a semi or anti join, and read as it lies."""
        return self._loads().select(self.key)

    def read(self) -> DataFrame:
        rows, added = self._loads(), list(self._known())
        if added:
            # A load leaves added columns that it lacks alone: the last value counts, whichever load it came with.
            ordered = Window.partitionBy(self.key).orderBy(_WRITTEN, _LOAD).rowsBetween(Window.unboundedPreceding, Window.currentRow)
            rows = rows.withColumns({c: F.last(c, ignorenulls=True).over(ordered) for c in added})
        return last_per_key(rows, self.key, [_WRITTEN, _LOAD]).select(self.schema.names)

    # ---- writing ----

    def _write(self, df: DataFrame, snapshot: int, load: str) -> None:
        rows = conform(df, self.schema).withColumn(_WRITTEN, F.lit(datetime.now(timezone.utc)))
        folder, name = f"{self.root}/{_SNAPSHOT}={snapshot}/{_LOAD}={load}", "keyed_" + uuid.uuid4().hex
        rows.repartition(self.buckets, self.key).write.mode("overwrite").bucketBy(self.buckets, self.key).sortBy(self.key).option(
            "path", folder).saveAsTable(name)
        self.spark.sql(f"drop table {name}")  # the files stay

    def upsert(self, df: DataFrame, load: str | None = None) -> None:
        """One row per key: known keys get the new row, new ones come in. ``load`` names what is written, to be known again."""
        self._write(df, max(0, self._last_snapshot()), load or uuid.uuid4().hex)

    def insert_new(self, df: DataFrame, load: str | None = None) -> None:
        """Rows of keys that the table lacks; the others stay untouched. One row per key."""
        self.upsert(not_in(df, self.keys(), self.key), load)

    def replace(self, df: DataFrame) -> None:
        """The new content stands for everything so far. The snapshot before stays for those who are reading it."""
        last = self._last_snapshot()
        self._write(df, last + 1, "all")
        for old in matching_paths(self.spark, f"{self.root}/{_SNAPSHOT}=*"):
            if int(old.rpartition("=")[2]) < last:
                delete_folder(self.spark, old)

    def rewrite(self) -> None:
        """One load in place of many."""
        self.replace(self.read())


class ReplacedTable:
    """A table that is loaded whole each time."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def replace(self, df: DataFrame) -> None:
        conform(df, self.schema).write.mode("overwrite").parquet(self.root)

    def read(self) -> DataFrame:
        return read_folder(self.spark, self.root, self.schema)


def utc_day(moment: Column) -> Column:
    """The day of a point in time, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(moment) / F.lit(86_400_000_000)).cast("int"))


class AppendTable:
    """Append-only rows, in day folders (UTC) of ``day_of`` where given."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, day_of: str | None = None):
        self.spark, self.root, self.schema, self.day_of = spark, root.rstrip("/"), schema, day_of

    @property
    def _day(self) -> str:
        return f"{self.day_of}_day"

    def append(self, df: DataFrame) -> None:
        rows = conform(df, self.schema)
        if self.day_of:
            rows.withColumn(self._day, utc_day(F.col(self.day_of))).write.mode("append").partitionBy(self._day).parquet(
                self.root)
        else:
            rows.write.mode("append").parquet(self.root)

    def read(self, since: datetime | Column | None = None) -> DataFrame:
        """``since``: day folders before it are not even listed for reading."""
        if not self.day_of:
            return read_folder(self.spark, self.root, self.schema)
        schema = T.StructType([*self.schema, T.StructField(self._day, T.DateType())])
        rows = read_folder(self.spark, self.root, schema)
        if since is not None:
            moment = F.lit(since).cast("timestamp")
            rows = rows.filter((F.col(self._day) >= utc_day(moment)) & (F.col(self.day_of) >= moment))
        return rows.drop(self._day)
