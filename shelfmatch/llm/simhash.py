"""SimHash near-duplicates: fingerprints of word shingles, linked by pigeonhole blocks, joined to components.

Fingerprints that differ in at most ``distance`` bits agree in at least ``blocks - distance`` of ``blocks`` blocks. Every
choice of so many blocks gives one join key; a close pair meets under at least one of them, is verified by its Hamming
distance, and only a spanning forest of a key's links leaves the task, so a group of near copies never becomes all its
pairs. Keys with many fingerprints are dealt out in pairs of tiles. Equal fingerprints are one node from the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmatch.llm.common import by_text, doc_texts, quoted, unused
from shelfmatch.session import materialize

SEED = 42


def shingle_hashes(text: str, width: int) -> list[int]:
    """XXH64 of every run of ``width`` words (all of them if fewer); words are split at ASCII white space."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    line, last = b" ".join(words), min(width, len(words)) - 1
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], stops[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], SEED) for a, b in zip(starts[: len(words) - last].tolist(), stops[last:].tolist(), strict=True)]


def fingerprint_of(hashes: list[int]) -> int:
    """64 bits, each set if it is set in over half the hashes; zero without hashes."""
    if not hashes:
        return 0
    set_in = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at:at + (1 << 16)], ">u8")
        set_in += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_in * 2 > len(hashes)).view(">u8")[0])


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """``doc_id`` and the 64-bit fingerprint as a long, one row per row of ``docs``. A null text counts as empty."""

    def read(texts: list[str]) -> list[pa.Array]:
        made = [fingerprint_of(shingle_hashes(t, width)) for t in texts]
        return [pa.array(np.array(made, np.uint64).view(np.int64))]

    return by_text(doc_texts(docs), lambda: read, "fp long")


def block_keys(blocks: int, distance: int) -> list[tuple[int, int]]:
    """For each choice of blocks that a close pair agrees in: its number and the mask of its bits."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [(i, sum(masks[b] for b in chosen)) for i, chosen in enumerate(combinations(range(blocks), blocks - distance))]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the graph of close pairs, by breadth-first search that looks at unreached ones only."""
    rest, edges = np.arange(len(fps)), []
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            here = queue.pop()
            near = np.bitwise_count(fps[rest] ^ fps[here]) <= distance
            if near.any():
                found = rest[near]
                edges += [(here, other) for other in found]
                queue.extend(found)
                rest = rest[~near]
    return edges


def close_pairs(fps: np.ndarray, groups: np.ndarray, distance: int, few: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Links of sorted groups: all close pairs of groups up to ``few``, a spanning forest of larger ones."""
    firsts = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
    sizes = np.diff(np.concatenate((firsts, [len(groups)])))
    size_at = np.repeat(sizes, sizes)
    left, right = [], []
    for step in range(1, few):
        here = np.flatnonzero((groups[step:] == groups[:-step]) & (size_at[step:] <= few))
        near = here[np.bitwise_count(fps[here] ^ fps[here + step]) <= distance]
        left.append(fps[near])
        right.append(fps[near + step])
    for first, size in zip(firsts[sizes > few].tolist(), sizes[sizes > few].tolist(), strict=True):
        own = fps[first:first + size]
        if edges := np.array(forest(own, distance), np.int64).reshape(-1, 2).T.tolist():
            left.append(own[edges[0]])
            right.append(own[edges[1]])
    return np.concatenate(left), np.concatenate(right)


def links(nodes: DataFrame, distance: int = 4, blocks: int = 6, tile: int = 8192) -> DataFrame:
    """Links ``a, b`` between close values of the distinct long column ``fp``, enough to give the same components as all.

    ``tile`` bounds the memory and the comparisons of one group: a key with more fingerprints is cut by hash, and each pair
    of cuts is a group of its own. No link is lost.
    """
    keyed = nodes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(signed(mask))).alias("v")) for i, mask in block_keys(blocks, distance)
    ])).alias("key")).select("key.k", "key.v", "fp")
    sizes = keyed.groupBy("k", "v").count().filter("count > 1").select(
        "k", "v", F.ceil(F.col("count") / tile).cast("int").alias("cuts"))
    met = keyed.join(sizes, ["k", "v"]).withColumn("cut", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("cuts")).cast("int"))
    # A cut meets every cut once; a key with one cut stays one row.
    tiles = met.select("k", "v", "fp", F.explode(F.expr(
        "case when cuts = 1 then array(0) else transform(sequence(0, cuts - 1), c -> least(c, cut) * cuts + greatest(c, cut)) end"
    )).alias("pair"))
    dealt = tiles.select("fp", F.xxhash64("k", "v", "pair").alias("grp"))
    dealt = dealt.repartition("grp").sortWithinPartitions("grp", "fp")
    shape = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_fp, kept_grp = np.empty(0, np.int64), np.empty(0, np.int64)

        def linked(fp: np.ndarray, grp: np.ndarray) -> Iterator[pa.RecordBatch]:
            if len(fp) > 1:
                a, b = close_pairs(fp.view(np.uint64), grp, distance)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=shape)

        for batch in batches:
            fp = np.concatenate((kept_fp, batch.column("fp").to_numpy(zero_copy_only=False)))
            grp = np.concatenate((kept_grp, batch.column("grp").to_numpy(zero_copy_only=False)))
            if not len(grp):
                continue
            ended = np.searchsorted(grp, grp[-1])  # the last group may go on in the next batch
            yield from linked(fp[:ended], grp[:ended])
            kept_fp, kept_grp = fp[ended:], grp[ended:]
        yield from linked(kept_fp, kept_grp)

    return dealt.mapInArrow(compare, "a long, b long").filter("a <> b").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b`` longs): the smallest node that it is connected with.

    Alternating stars: each node hooks what is larger to the smallest in its neighbourhood until nothing changes. A round
    is written to the shared folder, so lineage stays short and a lost executor costs one round. Rounds grow with the
    logarithm of the largest component; nodes and edges are only joined and grouped, never gathered.
    """
    now = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), name)
    state = None
    while True:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = materialize(small.unionAll(least.select("a", F.col("m").alias("b"))).distinct(), name)
        # Done when the rows no longer change: every node then points to its root and to nothing else.
        found = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)")).alias("s")).first()
        if found == state:
            break
        state = found
    pairs = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return pairs.unionAll(pairs.select(F.col("root").alias("node"), "root").distinct())


def grouped(docs: DataFrame, width: int, distance: int, blocks: int = 6, tile: int = 8192) -> DataFrame:
    """``doc_id, fp, root, component_id``: a fingerprint, the node that names its component, the smallest id in there."""
    marked = materialize(fingerprints(docs, width), "fingerprints")
    nodes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint-nodes")
    found = components(links(nodes, distance, blocks, tile), "fingerprint-links")
    rooted = nodes.join(found, nodes.fp == found.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    owners = rooted.join(least, "root").select("fp", "root", "component_id")
    return marked.join(owners, "fp")


def near_duplicates(docs: DataFrame, width: int = 4, distance: int = 4, blocks: int = 6, tile: int = 8192) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    Null or empty texts and texts of white space have fingerprint zero and link like any other. Repeated rows stay, each
    with the same result. A null ``doc_id`` never is a component's id while any other id is in reach. An empty table gives
    an empty result; other columns are not read.
    """
    return grouped(docs, width, distance, blocks, tile).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame, width: int = 4, distance: int = 4) -> DataFrame:
    """The rows of ``docs`` that stand for their group of near duplicates, with all their columns.

    Of a group the document with the smallest id stays; of rows with one id the one with the smallest text. A row without an
    id stays only if its whole group has no id, and of such a group one row stays.
    """
    own = [quoted(c) for c in docs.columns]
    found = materialize(grouped(docs, width, distance), "near-duplicates")

    def least_row(rows: DataFrame, key: str) -> DataFrame:
        """Reduced in each task before the shuffle, so rows that share a key never meet in one task."""
        row = F.min_by(F.struct(*own), F.struct("text", F.hash(*own))).alias("row")
        return rows.groupBy(quoted(key)).agg(row).select("row.*")

    stay = found.filter("doc_id = component_id").select("doc_id").distinct()
    often = materialize(found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated-ids")
    kept = docs.join(stay, "doc_id", "left_semi").select(*own)
    if not often.isEmpty():
        several = least_row(kept.join(often, "doc_id", "left_semi").select(*own), "doc_id")
        kept = kept.join(often, "doc_id", "left_anti").select(*own).unionByName(several)
    alone = materialize(found.filter("component_id is null").groupBy("root").agg(F.min("fp").alias("fp")).select("fp"), "nameless")
    if not alone.isEmpty():
        mark = unused("fp", docs.columns)

        def read(texts: list[str]) -> list[pa.Array]:
            made = [fingerprint_of(shingle_hashes(t, width)) for t in texts]
            return [pa.array(np.array(made, np.uint64).view(np.int64))]

        marked = by_text(docs.filter("doc_id is null"), lambda: read, f"{quoted(mark)} long", tuple(docs.columns)).join(
            alone.withColumnRenamed("fp", mark), mark, "left_semi")
        kept = kept.unionByName(least_row(marked, mark))
    return kept
