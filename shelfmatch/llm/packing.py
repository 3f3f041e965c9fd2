"""Best-fit packing of documents into sequences of several permitted lengths.

Documents longer than the longest sequence are cut; full pieces are sequences of their own. The rest go by decreasing
length, each into the open sequence with the least room left that still holds it. If none does, a sequence of the length
that is cheapest for each token it is going to hold is opened, judged by filling it in thought with the items still to
come. In the end every sequence is downsized to the shortest permitted length that holds its contents.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.session import materialize

#: Permitted lengths of sequences, and what a sequence costs beside its length.
SIZES, OVERHEAD = (512, 1024, 2048, 4096), 32
#: Items that are packed together; more groups of them lose at most one part-filled sequence a length each.
GROUP = 50_000


def word_count(text: Column) -> Column:
    """Words between white space."""
    return F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))


class Remaining:
    """How many items of each length are still to come, and the longest of them that fits some room."""

    def __init__(self, lengths: list[int], most: int):
        self.count = [0] * (most + 1)
        for n in lengths:
            self.count[n] += 1
        self.present = sorted({n for n in lengths})

    def drop(self, n: int) -> None:
        self.count[n] -= 1
        if not self.count[n]:
            self.present.pop(bisect_left(self.present, n))

    def filled(self, room: int) -> int:
        """How much of ``room`` the longest fitting items would take, one after another."""
        taken, at = 0, len(self.present)
        while room:
            at = bisect_left(self.present, room + 1, 0, at) - 1
            if at < 0:
                break
            n = self.present[at]
            k = min(self.count[n], room // n)
            taken, room = taken + k * n, room - k * n
        return taken


def best_fit(lengths: list[int], sizes: tuple[int, ...], cost: Callable[[int], float]) -> tuple[list[int], list[int]]:
    """The bin of each of ``lengths`` (in decreasing order) and the size of each bin, downsized.

    Of bins with equal room the one opened first is taken; of sizes that cost the same a token the smaller.
    """
    rooms: list[tuple[int, int]] = []  # room left, bin; sorted
    used: list[int] = []
    at = []
    rest = Remaining(lengths, sizes[-1])
    for n in lengths:
        rest.drop(n)
        k = bisect_left(rooms, (n, -1))
        if k < len(rooms):
            room, bin_ = rooms.pop(k)
        else:
            room = min((s for s in sizes if s >= n), key=lambda s: (cost(s) / (n + rest.filled(s - n)), s))
            bin_ = len(used)
            used.append(0)
        used[bin_] += n
        at.append(bin_)
        if room > n:
            insort(rooms, (room - n, bin_))
    return at, [next(s for s in sizes if s >= u) for u in used]


def pack(docs: DataFrame, length: Column, sizes: tuple[int, ...] = SIZES, overhead: float = OVERHEAD, group_items: int = GROUP) -> DataFrame:
    """``doc_id, piece, start, n_tokens, sequence, capacity, place`` for every piece of every row of ``docs``.

    ``start`` is where the piece begins in its document, ``place`` where it begins in its ``sequence`` (an identifier unique
    in the result), ``capacity`` that sequence's length. Rows with a null or zero length get one piece of no tokens and no
    sequence. Repeated rows are packed each. An empty table gives an empty result.

    Items are dealt into groups by a hash, about ``group_items`` each, so no task holds more than a group; whole pieces
    never are items. Other columns are not read but for those that ``length`` is made of.
    """
    sizes = tuple(sorted(sizes))
    longest = sizes[-1]
    rows = docs.select("doc_id", F.coalesce(length, F.lit(0)).cast("long").alias("n")).withColumn("row", F.monotonically_increasing_id())
    rows = materialize(rows, "pack-lengths")  # row numbers must not change between readings
    items = rows.withColumn("whole", F.floor(F.col("n") / longest).cast("long"))
    full = items.filter("whole > 0").select("doc_id", F.expr("explode(sequence(0L, whole - 1))").alias("piece"), "row").select(
        "doc_id", "piece", (F.col("piece") * longest).alias("start"), F.lit(longest).cast("long").alias("n_tokens"),
        F.concat_ws("-", F.lit("f"), "row", "piece").alias("sequence"), F.lit(longest).cast("long").alias("capacity"), F.lit(0).cast("long").alias("place"))
    empty = items.filter("n = 0").select(
        "doc_id", F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("n_tokens"),
        F.lit(None).cast("string").alias("sequence"), F.lit(None).cast("long").alias("capacity"), F.lit(None).cast("long").alias("place"))
    parts = items.filter(F.col("n") % longest > 0).select(
        "doc_id", F.col("whole").alias("piece"), (F.col("whole") * longest).alias("start"), (F.col("n") % longest).alias("n_tokens"), "row")
    groups = max(1, -(-rows.count() // group_items))
    dealt = parts.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "row"), F.lit(groups)))
    id_kind = parts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in range(4)]
        now = None

        def packed() -> Iterator[pa.RecordBatch]:
            if held[0]:
                lengths = held[3]
                at, capacity = best_fit(lengths, sizes, lambda s: s + overhead)
                place, used = [], [0] * len(capacity)
                for n, b in zip(lengths, at, strict=True):
                    place.append(used[b])
                    used[b] += n
                own = [held[0], held[1], held[2], lengths, [f"{now}-{b}" for b in at], [capacity[b] for b in at], place]
                types = [id_type, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(own, types, strict=True)],
                                                 ["doc_id", "piece", "start", "n_tokens", "sequence", "capacity", "place"])

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            group = batch.column("grp").to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(group)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if group[a] != now:
                    yield from packed()
                    held, now = [[] for _ in range(4)], group[a]
                for column, name in zip(held, ("doc_id", "piece", "start", "n_tokens"), strict=True):
                    column += batch.column(name).slice(a, b - a).to_pylist()
        yield from packed()

    ordered = dealt.repartition("grp").sortWithinPartitions("grp", F.desc("n_tokens"), "doc_id", "row")
    fitted = ordered.select("grp", "doc_id", "piece", "start", "n_tokens").mapInArrow(
        run, f"doc_id {id_kind}, piece long, start long, n_tokens long, sequence string, capacity long, place long")
    return fitted.unionByName(full).unionByName(empty)
