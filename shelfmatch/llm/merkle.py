"""Merkle manifest of a table: hash trees built by joining every node with its siblings at shifted places.

A tree's leaves have places 0, 1, 2, ...; ``arity`` consecutive places make a run, and a place in a run is a slot. On every
level each node is joined with the other nodes of its run by their computed places: the place XOR 1 in a binary tree, else the
slot plus 1, 2, ... modulo the arity. All these equi joins share one partitioning by run, and a key is one node, so a
tree that holds most of all rows is as spread out as any other. The rows of slot 0 then give their run's parent. On the way
down each node's path, its siblings on every level to the root, is its own siblings before its parent's path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.session import materialize

#: Siblings left and right of a node, concatenated, by level from the node up.
PATH = "array<struct<left:string,right:string>>"


def hashed(text: Column) -> Column:
    return F.sha2(text, 256)


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    """The hash of a row: of its values one after the other, each with its length."""
    return hashed(F.concat(*map(field, values)))


def placed(rows: DataFrame, tree: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``rows`` with ``place``, the number of a row in its ``tree`` in the given order, and ``size``, the rows of the tree.

    No tree is gathered: rows are dealt out by ranges of (tree, order), where each range numbers its own; only the
    counts of each range and tree, a row for either at most, are added up.
    """
    ranged = materialize(
        rows.repartitionByRange(*tree, *order).sortWithinPartitions(*tree, *order).withColumn("_at", F.monotonically_increasing_id()),
        "ranges").withColumn("_range", F.shiftright("_at", 33))
    parts = ranged.groupBy(*tree, "_range").agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    # Ranges up to a tree's own, by a join of a tree's ranges with its totals: ranges are few, a fixed number for a session.
    spans = parts.groupBy(*tree).agg(
        F.sum("_rows").alias("size"), F.array_sort(F.collect_list(F.struct("_range", "_rows", "_first"))).alias("_parts"))
    before = spans.select(*tree, "size", F.inline(F.expr("""transform(_parts, (p, i) -> named_struct('_range', p._range,
        '_shift', p._first - aggregate(slice(_parts, 1, i), 0L, (n, q) -> n + q._rows)))""")))
    return ranged.join(before, [*tree, "_range"]).withColumn("place", F.col("_at") - F.col("_shift")).drop("_at", "_range", "_shift")


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes`` with the digests ``left`` and ``right`` of them in their run, concatenated in order."""
    # Rows dealt out by run need not be dealt out again to be joined by run and place.
    nodes.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    slot = (F.col("place") % arity).cast("int")
    dealt = nodes.withColumn("run", F.expr(f"place div {arity}")).repartition("tree", "run")
    found = dealt
    for shift in range(1, arity):
        here = F.col("place").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("run") * arity + F.pmod(F.col("place") + shift, F.lit(arity))
        others = dealt.select("tree", "run", F.col("place").alias("wanted"), F.col("digest").alias(f"s{shift}"))
        found = found.withColumn("wanted", here).join(others, ["tree", "run", "wanted"], "left").drop("wanted")
    # In the order of shifts come the slots behind a node's own, then from 0 those before it; a short run has nulls.
    siblings = F.array(*[F.col(f"s{shift}") for shift in range(1, arity)])
    return found.withColumns({
        "right": F.array_join(F.slice(siblings, 1, arity - 1 - slot), ""),
        "left": F.array_join(F.slice(siblings, arity - slot, slot), ""),
    }).drop(*[f"s{shift}" for shift in range(1, arity)])


def climb(leaves: DataFrame, arity: int, name: str = "merkle") -> tuple[list[DataFrame], DataFrame]:
    """The levels with several nodes a tree, from the leaves up, and ``tree, digest`` of every tree's root.

    ``leaves``: ``tree`` (not null), ``place``, ``size`` (of the tree), ``digest``, and what else is kept on the lowest level.
    A level has these, ``run``, ``left`` and ``right``. Each is written and is an ``arity``-th of the one below.
    """
    most = leaves.agg(F.max("size")).first()[0] or 0
    levels, roots, nodes = [], leaves.filter("size = 1").select("tree", "digest"), leaves
    while most > 1:
        level = materialize(with_siblings(nodes.filter("size > 1"), arity), f"{name}-level")
        nodes = level.filter(F.col("place") % arity == 0).select(
            "tree", F.col("run").alias("place"), F.expr(f"(size + {arity - 1}) div {arity}").alias("size"),
            hashed(F.concat("digest", "right")).alias("digest"))
        levels.append(level)
        roots = roots.unionByName(nodes.filter("size = 1").select("tree", "digest"))
        most = -(-most // arity)
    return levels, roots


def leaf_paths(leaves: DataFrame, levels: list[DataFrame], arity: int, tops: DataFrame) -> DataFrame:
    """``leaves`` with their ``path`` to their tree's root, and on by ``tops``' ``path`` of the tree (``tree, path, ...``)."""
    ends = tops.withColumns({"run": F.lit(0).cast("long"), "last": F.lit(True)})
    rest = [c for c in tops.columns if c != "path"]
    above = ends
    for level in reversed(levels):
        kept = [c for c in level.columns if c not in ("left", "right", "run")] if level is levels[0] else ["tree", "place"]
        more = [c for c in rest if c != "tree"]
        # A run whose parent is the root is continued by the root's own path, any other by its parent's.
        found = level.withColumn("last", F.col("size") <= arity).join(
            above.withColumnRenamed("path", "_above"), ["tree", "run", "last"]).select(
            *kept, *more, F.concat(F.array(F.struct("left", "right")), "_above").alias("path"))
        if level is not levels[0]:
            above = found.withColumnRenamed("place", "run").withColumn("last", F.lit(False)).unionByName(ends)
    alone = leaves.filter("size = 1").join(tops, "tree")
    return found.unionByName(alone.select(found.columns)) if levels else alone


def folded(digest: Column, path: Column) -> Column:
    """The root that a digest and its path lead to."""
    return F.aggregate(path, digest, lambda own, step: hashed(F.concat(step["left"], own, step["right"])))


def proof(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def manifest(rows: DataFrame, columns: Sequence[str], key: str, tree: str, arity: int = 8,
             also: dict[str, Column] | None = None) -> DataFrame:
    """For every row ``key``, what ``also`` names (columns over ``rows``), ``leaf``, ``subroot``, ``root`` and ``path``.

    A row's leaf is the hash of its ``columns``, null told from empty. The rows of one value of ``tree`` (text; null is one
    too) make a tree in the order of ``key``, null first; equal keys follow in the order of their leaves, and wholly equal
    rows have a place each. Its root, of a single row the leaf itself, is the subroot; the subroots in the order of
    ``tree``, null first and by bytes, make the tree of the root. Texts are read once, where they lie, and only digests move.
    An empty table gives an empty result; columns that are not named are not read.
    """
    also = also or {}
    leaves = materialize(rows.select(
        F.coalesce(F.concat(F.lit("1"), F.col(tree).cast("string")), F.lit("0")).alias("tree"), F.col(key).alias("key"),
        leaf([F.col(c) for c in columns]).alias("digest"), F.struct(F.lit(0).alias("_"), *[c.alias(n) for n, c in also.items()]).alias("also"),
    ).withColumn("row", F.monotonically_increasing_id()), "leaves")
    leaves = materialize(placed(leaves, ["tree"], ["key", "digest", "row"]).drop("row"), "placed-leaves")
    levels, roots = climb(leaves, arity)
    subroots = materialize(placed(roots.select(F.lit("").alias("tree"), F.col("tree").alias("own"), "digest"), ["tree"], ["own"]), "subroots")
    upper, top = climb(subroots, arity, "merkle-top")
    root = top.first()
    nothing = subroots.select("tree").distinct().withColumn("path", F.array().cast(PATH))
    tops = leaf_paths(subroots, upper, arity, nothing).select(F.col("own").alias("tree"), "path", F.col("digest").alias("subroot"))
    return leaf_paths(leaves, levels, arity, tops).select(
        F.col("key").alias(key), *[F.col("also")[n].alias(n) for n in also], F.col("digest").alias("leaf"), "subroot",
        F.lit(root["digest"] if root else None).cast("string").alias("root"), "path")


def checked(found: DataFrame, digest: Column) -> DataFrame:
    """A manifest with the ``folded_root`` that ``digest`` leads to in place of the leaf, and whether it is ``verified``."""
    return found.withColumn("folded_root", folded(digest, F.col("path"))).withColumn("verified", F.col("folded_root") == F.col("root"))
