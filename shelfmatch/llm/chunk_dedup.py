"""Exact dedup by content-defined chunk recipes.

A text is cut where a rolling hash of its last 32 bytes has a certain form, so equal texts are cut alike wherever they lie.
Each chunk gets an identifier, a hash that is *verified*: every distinct chunk travels once, equal chunks of a task only
together, and no two unequal chunks may have one identifier, else all is told anew with a wider hash. A document's recipe
is the ordered list of its chunks' identifiers. Two texts are equal exactly if their recipes are, so from there on only recipes
move, 16 bytes for about two thousand of text, and a long document is never moved whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.llm.common import doc_texts
from shelfmatch.session import materialize

#: Bytes of the shortest chunk but a text's last, of the longest, and how many places apart a cut is on average beyond the shortest.
LEAST, MOST, MEAN = 512, 16_384, 2_048
_WINDOW = 32
#: One random 32-bit number for each byte value.
_GEAR = np.random.default_rng(11).integers(0, 1 << 32, 256, np.uint32)


def rolling(data: np.ndarray) -> np.ndarray:
    """At each place a hash of the last ``_WINDOW`` bytes up to there: gear numbers, each shifted by its age."""
    sums, age = _GEAR[data], 1
    while age < _WINDOW:
        older = sums[:-age] << np.uint32(age)
        sums[age:] += older
        age *= 2
    return sums


def cuts(lengths: np.ndarray, data: np.ndarray, least: int = LEAST, most: int = MOST, mean: int = MEAN) -> Iterator[list[int]]:
    """For each of several texts that lie behind each other in ``data``: where its chunks end, from the text's start.

    A cut looks at bytes of its own text only: none is nearer to the start than the window is wide.
    """
    if not _WINDOW <= least <= most:
        raise ValueError("a chunk is as long as the window at least")
    ends = np.flatnonzero(rolling(data) < np.uint32((1 << 32) // mean)) + 1 if len(data) else np.empty(0, np.int64)
    start = 0
    for length in lengths.tolist():
        own = ends[np.searchsorted(ends, start + least):np.searchsorted(ends, start + length)] - start if length > least else ends[:0]
        found, at = [], 0
        while length - at > least:
            k = np.searchsorted(own, at + least)
            at = min(int(own[k]) if k < len(own) else length, at + most, length)
            found.append(at)
        if at < length:
            found.append(length)
        yield found
        start += length


def chunked(texts: pa.Array, **sizes: int) -> Iterator[list[memoryview]]:
    """The chunks of each text of a batch; no chunk for an empty text."""
    whole = texts.cast(pa.large_binary())
    offsets = np.frombuffer(whole.buffers()[1], np.int64, len(whole) + 1, whole.offset * 8) if len(whole) else np.zeros(1, np.int64)
    data = memoryview(whole.buffers()[2] or b"")[offsets[0]:offsets[-1]] if len(whole) else memoryview(b"")
    start = 0
    for length, ends in zip(np.diff(offsets).tolist(), cuts(np.diff(offsets), np.frombuffer(data, np.uint8), **sizes), strict=True):
        yield [data[start + a:start + b] for a, b in zip([0, *ends], ends, strict=False)]
        start += length


def _identify(bits: int) -> Callable[[memoryview], bytes]:
    """An identifier of 16 bytes, of which the first ``bits`` bits count."""
    if bits >= 128:
        return xxhash.xxh3_128_digest
    return lambda chunk: (xxhash.xxh3_128_intdigest(chunk) >> (128 - bits)).to_bytes(16, "big")


def recipes(docs: DataFrame, bits: int = 128, keep: tuple[str, ...] = (), **sizes: int) -> DataFrame:
    """``doc_id``, what ``keep`` names, and the binary ``recipe`` of every row; an empty or null text has an empty recipe."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    rows = docs.select("doc_id", *keep, F.coalesce(F.col("text"), F.lit("")).alias("text"))
    out = StructType([*rows.schema.fields[:-1], *StructType.fromDDL("recipe binary").fields])
    shape = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = _identify(bits)
        for batch in batches:
            made = pa.array([b"".join(map(name, own)) for own in chunked(batch.column("text"), **sizes)], pa.binary())
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip([*batch.columns[:-1], made], shape, strict=True)], schema=shape)

    return rows.mapInArrow(run, out)


def distinct_chunks(docs: DataFrame, bits: int = 128, **sizes: int) -> DataFrame:
    """``id, chunk`` of every distinct chunk of ``docs``. Equal chunks of a batch leave it once, and of a task together."""
    shape = pa.schema([("id", pa.binary()), ("chunk", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = _identify(bits)
        for batch in batches:
            # By the bytes themselves, not by a hash of them.
            own = list({bytes(c): None for text in chunked(batch.column("text"), **sizes) for c in text})
            yield pa.RecordBatch.from_arrays([pa.array([name(c) for c in own], pa.binary()), pa.array(own, pa.binary())], schema=shape)

    return docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInArrow(run, "id binary, chunk binary").distinct()


def verified_bits(docs: DataFrame, bits: int = 128, **sizes: int) -> int:
    """The least doubling of ``bits`` whose identifiers tell all distinct chunks of ``docs`` apart, told by their bytes."""
    while True:
        shared = distinct_chunks(docs, bits, **sizes).groupBy("id").count().filter("count > 1")
        if shared.isEmpty():
            return bits
        if bits >= 128:
            raise RuntimeError("two different chunks have one 128-bit identifier; cut by other sizes")
        bits = min(128, bits * 2)


def exact_groups(docs: DataFrame, bits: int = 128, normalised: Column | None = None, **sizes: int) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    Texts are equal when identical byte for byte after ``normalised`` (a column over ``text``; nothing is changed if not
    given). Of equal texts the row with the largest id stays; of such rows with one id exactly one does, a row without an
    id only where no equal text has one (``keep_id`` is null then). Null texts count as empty and equal other empty ones.
    Repeated rows each get a row. An empty table gives an empty result; other columns are not read. ``sizes`` go to ``cuts``.
    """
    texts = doc_texts(docs) if normalised is None else docs.select("doc_id", F.coalesce(normalised, F.lit("")).alias("text"))
    bits = verified_bits(texts, bits, **sizes)
    told = recipes(texts.withColumn("text_sha256", F.sha2("text", 256)), bits, ("text_sha256",), **sizes)
    # Rows get numbers when written, so that they stay the same however often a task is repeated.
    rows = materialize(told.withColumn("row", F.monotonically_increasing_id()), "recipes")
    # A group's rows are counted, and told what was found, in shares: no task gets all rows of a text with many copies.
    shares = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("share", F.pmod(F.xxhash64("row"), F.lit(shares)))
    parts = rows.groupBy("recipe", "share").agg(F.count("*").alias("n"), F.max(F.struct("doc_id", "row")).alias("last"))
    groups = parts.groupBy("recipe").agg(F.sum("n").alias("group_size"), F.max("last").alias("last"))
    shared = parts.select("recipe", "share").join(groups, "recipe")
    return rows.join(shared, ["recipe", "share"]).select(
        "doc_id", F.col("last.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("last.row")).alias("kept"), "text_sha256")
