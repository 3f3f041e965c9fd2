"""Exact similarity join of distinct texts inside equal blocks.

Result: every pair of texts in one block whose indel similarity reaches the threshold, and no other pair. Columns
carried by the right side come along, so a caller can aggregate the pairs where they are made instead of shuffling
them into another join. A caller that needs only some pairs of each text, such as the best, passes ``thin``, which
drops the others inside each task: then a block of near copies yields rows in proportion to its texts, not its pairs.

Both sides meet by one shuffle, in *units* of at most ``UNIT`` texts a side. A block that fits is one unit. A larger one is
cut by bands of length and by hash, and two cuts meet in a unit only if texts of their lengths can be similar at all, so
most of a wide block's pairs are never made up. A text is copied once for each unit it is in: with n texts in bands that
can match, n / ``UNIT`` copies (at a threshold of 75 texts differ by less than a factor 5/3 in length, three bands). Inside
a task many small units are compared at once, large ones by cells of a metric space and in waves (``functions/letter_space.py``);
memory is bounded by a unit.

Between tasks texts are not dealt out by cells: at a threshold of three quarters a text reaches about half the cells that
have a unit's size, and a finer cut would copy it more often than units do. Inside a task a visit costs no copy.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shelfmatch.functions.letter_space import close_pairs
from shelfmatch.functions.similarity import scored_pairs

Thin = Callable[[pa.Table], pa.Table]

UNIT = 16_384
TILE = 1024
#: Pairs of small units that are compared at once, the largest small unit, and rows that are read at once.
PAIRS, SMALL, ROWS = 400_000, 16_384, 65_536


def length_band(length: Column, threshold: int) -> Column:
    """Texts whose bands differ by two or more cannot reach the threshold; empty texts have a band of their own."""
    # min/max of two similar lengths is at least t / (200 - t); a hair less, so rounding never separates a pair.
    step = -math.log(min(max(threshold, 1) / (200 - threshold), 0.98) * 0.999)
    return F.when(length == 0, F.lit(-9)).otherwise(F.floor(F.log(length.cast("double")) / step).cast("int"))


def with_units(left: DataFrame, right: DataFrame, threshold: int, unit: int, carry: Sequence[str]) -> DataFrame:
    """Rows of both sides, each once for every unit it is compared in: ``u1, u2`` (the unit), ``side, block, text``, carried.

    A threshold below 1 lets any lengths match; then there is one band.
    """
    band = length_band(F.char_length("text"), threshold) if threshold >= 1 else F.lit(0)
    nothing = [F.lit(None).cast(right.schema[name].dataType).alias(name) for name in carry]
    both = left.select("block", "text", *nothing, F.lit(0).alias("side")).unionAll(
        right.select("block", "text", *carry, F.lit(1).alias("side"))).withColumn("band", band)
    counts = both.groupBy("block", "band").agg(
        F.count_if(F.col("side") == 0).alias("lefts"), F.count_if(F.col("side") == 1).alias("rights"))
    cuts = F.struct("band", F.ceil(F.col("lefts") / unit).cast("int").alias("l"), F.ceil(F.col("rights") / unit).cast("int").alias("r"))
    # Blocks that only one side has fall away here.
    blocks = counts.groupBy("block").agg(
        F.sum("lefts").alias("lefts"), F.sum("rights").alias("rights"), F.collect_list(cuts).alias("bands")).filter(
        "lefts > 0 and rights > 0").withColumn("whole", (F.col("lefts") <= unit) & (F.col("rights") <= unit)).withColumn(
        "bands", F.when(~F.col("whole"), F.col("bands"))).select("block", "whole", "bands")
    met = both.join(blocks, "block").withColumn("cut", F.pmod(F.xxhash64("text"), F.lit(1 << 40)))
    # For a row of either side the cuts of the other side's bands that are near; its own cut by hash.
    parts = F.expr("""case when whole then array(named_struct('lb', -1, 'lc', 0, 'rb', -1, 'rc', 0))
      when side = 0 then flatten(transform(filter(bands, b -> abs(b.band - band) <= 1 and b.r > 0), b -> transform(
        sequence(0, b.r - 1), c -> named_struct('lb', band, 'lc', cast(cut % filter(bands, o -> o.band = band)[0].l as int), 'rb', b.band, 'rc', c))))
      else flatten(transform(filter(bands, b -> abs(b.band - band) <= 1 and b.l > 0), b -> transform(
        sequence(0, b.l - 1), c -> named_struct('lb', b.band, 'lc', c, 'rb', band, 'rc', cast(cut % filter(bands, o -> o.band = band)[0].r as int))))) end""")
    spread = met.select("block", "text", "side", *carry, F.explode(parts).alias("part"))
    # Two hashes, 128 bits, name a unit.
    key = [F.xxhash64("block", "part", F.lit(seed)).alias(f"u{seed}") for seed in (1, 2)]
    return spread.select(*key, "side", "block", "text", *carry)


def similar_texts(left: DataFrame, right: DataFrame, threshold: int, unit: int = UNIT, tile: int = TILE,
                  carry: Sequence[str] = (), thin: Thin | None = None, until: tuple[str, float] | None = None) -> DataFrame:
    """``left`` and ``right``: distinct ``block, text``. Returns ``block, left_text, right_text``, ``carry``, ``score``.

    ``thin`` maps a table of pairs (with a column ``left`` that numbers the left texts) to a part of it; it is called several
    times and must keep every pair that could still be picked from a larger table. ``until`` (a carried column, a score): of
    each left text's pairs none is needed behind its first one of that score in the order of that column, so large units
    may leave such pairs out.
    """
    rows = with_units(left, right, threshold, unit, carry).repartition("u1", "u2").sortWithinPartitions("u1", "u2", "side")
    schema = T.StructType([
        left.schema["block"], T.StructField("left_text", T.StringType()), T.StructField("right_text", T.StringType()),
        *[right.schema[name] for name in carry], T.StructField("score", T.DoubleType())])
    shape, names = to_arrow_schema(schema), list(carry)

    def pairs_of(table: pa.Table, i: np.ndarray, j: np.ndarray, scores: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(i):
            return
        left_at, right_at = pa.array(i), pa.array(j)
        columns = {"left": left_at, "block": table.column("block").take(left_at),
                   "left_text": table.column("text").take(left_at), "right_text": table.column("text").take(right_at)}
        columns |= {name: table.column(name).take(right_at) for name in names} | {"score": pa.array(scores, pa.float64())}
        found = pa.table(columns)
        yield from (thin(found) if thin else found).select(shape.names).cast(shape).to_batches()

    def compared(table: pa.Table) -> Iterator[pa.RecordBatch]:
        """All pairs of whole units."""
        u1, u2, side = (table.column(i).to_numpy() for i in range(3))
        texts = table.column("text").to_pylist()
        edges = np.flatnonzero(np.concatenate(([True], (u1[1:] != u1[:-1]) | (u2[1:] != u2[:-1]))))
        lefts = np.add.reduceat(side == 0, edges)
        stops = np.append(edges[1:], len(side))
        held: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                i, j = (np.concatenate(part) for part in zip(*held))
                i, j, scores = scored_pairs(texts, i, j, threshold)
                yield from pairs_of(table, i, j, scores)

        for start, count, stop in zip(edges.tolist(), lefts.tolist(), stops.tolist()):
            middle = start + count
            n, m = count, stop - middle
            if n * m <= SMALL:
                if n * m:
                    held.append((np.repeat(np.arange(start, middle), m), np.tile(np.arange(middle, stop), n)))
                    waiting += n * m
                if waiting > PAIRS:
                    yield from flush()
                    held, waiting = [], 0
                continue
            order = pc.array_sort_indices(table.column(until[0]).slice(middle, m).combine_chunks()).to_numpy() if until else None
            for i, j, scores in close_pairs(texts[start:middle], texts[middle:stop], threshold, tile, order, until and until[1]):
                yield from pairs_of(table, i + start, j + middle, scores)
        yield from flush()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < ROWS:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            u1, u2 = table.column(0).to_numpy(), table.column(1).to_numpy()
            # The last unit may go on in the next batch.
            ended = int(np.flatnonzero((u1 != u1[-1]) | (u2 != u2[-1])).max(initial=-1)) + 1
            if ended:
                yield from compared(table.slice(0, ended).combine_chunks())
            held = table.slice(ended).to_batches()
            size = table.num_rows - ended if ended else 0  # a unit of more rows than that: read on
        if held and (table := pa.Table.from_batches(held).combine_chunks()).num_rows:
            yield from compared(table)

    return rows.mapInArrow(run, schema)
