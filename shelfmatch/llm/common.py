"""Small helpers the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.session import tune

#: Rows and bytes that go to a Python worker at once; long texts make smaller batches.
BATCH_ROWS, BATCH_BYTES = "2000", "4m"


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings of the library, and small Arrow batches so that memory doesn't depend on the longest texts."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def doc_texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty), and nothing else that could clash with an operator's own columns."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a row is kept from all learning: crc32 of the id as text, divisible by the number of folds.

    A null id counts as the text ``null``, so that such a row has a defined side too.
    """
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % folds == 0


def by_text(docs: DataFrame, reader: Callable[[], Callable[[list[str]], list[pa.Array]]], columns: str,
            keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Read whole texts in Arrow batches; ``keep`` and the arrays made of a batch (of schema ``columns``) come out.

    A null text is read as an empty one. ``reader`` is called once a task, so that models and tables are set up once and
    not sent with every batch. ``columns`` must not clash with ``keep``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out = StructType([docs.schema[c] for c in keep] + StructType.fromDDL(columns).fields)
    shape = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = reader()
        for batch in batches:
            if not batch.num_rows:
                continue
            made = read(batch.column(len(keep)).to_pylist())
            arrays = [batch.column(i) for i in range(len(keep))] + list(made)
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, shape, strict=True)], schema=shape)

    read_as = unused("text", keep)
    return docs.select(*[F.col(quoted(c)) for c in keep], F.coalesce(F.col("text"), F.lit("")).alias(read_as)).mapInArrow(run, out)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def unused(name: str, taken: Iterable[str]) -> str:
    """A column name like ``name`` that none of ``taken`` is, whatever its case."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name += "_"
    return name
