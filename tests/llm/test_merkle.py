import hashlib
import random

import pytest
from pyspark.sql import functions as F

from shelfmatch.llm import merkle as mk
from tests.llm.conftest import prose

COLUMNS = ["doc_id", "lang", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree_paths(digests, arity):
    """The root, and for each leaf its siblings (left, right) level by level."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for leaf, i in enumerate(at):
            first = i // arity * arity
            paths[leaf].append(("".join(digests[first:i]), "".join(digests[i + 1:first + arity])))
        at = [i // arity for i in at]
        digests = [sha("".join(digests[i:i + arity])) for i in range(0, len(digests), arity)]
    return digests[0], paths


def by_loop(rows, arity=8):
    trees = {}
    for i, text, lang in rows:
        trees.setdefault(lang, []).append((i is not None, i or 0, leaf_of(i, lang, text), i))
    named = sorted(trees, key=lambda v: (v is not None, (v or "").encode()))
    below = {v: tree_paths([r[2] for r in sorted(trees[v], key=lambda r: r[:3])], arity) for v in named}
    root, above = tree_paths([below[v][0] for v in named], arity)
    out = []
    for k, v in enumerate(named):
        for (_, _, leaf, i), path in zip(sorted(trees[v], key=lambda r: r[:3]), below[v][1], strict=True):
            out.append((i, leaf, below[v][0], root, tuple(path + above[k])))
    return sorted(out, key=str)


def collected(found):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, tuple(map(tuple, r.path))) for r in found.collect()), key=str)


def many(n=150):
    rng = random.Random(9)
    return [(i * 7919 % 100_003, prose(rng, 5), rng.choice(["de", "de", "de", "en", "é", None, "", f"x{i}"])) for i in range(n)]


@pytest.mark.parametrize("arity", [2, 3, 8])
def test_rows(docs, awkward, arity):
    rows = [(*r, None) for r in awkward] + [(5, awkward[4][1], "en"), (5, awkward[4][1], "en"), (77, "alone", "zz")] + many()
    out = mk.manifest(docs(rows), COLUMNS, "doc_id", "lang", arity)
    assert collected(out) == by_loop(rows, arity)
    assert mk.checked(out, F.col("leaf")).filter("not verified").isEmpty()


@pytest.mark.parametrize("n", [0, 1, 2, 8, 9, 64, 65])
def test_sizes(docs, n):
    rows = [(i, f"text {i}", "en") for i in range(n)]
    out = mk.manifest(docs(rows, 2), COLUMNS, "doc_id", "lang")
    assert collected(out) == (by_loop(rows) if rows else [])
    if n == 1:
        assert out.first()["path"] == [] and out.first()["root"] == out.first()["leaf"]


def test_many_equal_rows_have_places_of_their_own(docs):
    """One row a hundred times: no range, tree or task holds them because they are equal, and each has its own path."""
    rows = [(1, "same", "en")] * 100 + many(20)
    assert collected(mk.manifest(docs(rows), COLUMNS, "doc_id", "lang")) == by_loop(rows)


def test_tampering_shows(docs):
    rows = many(60)
    altered = F.when(F.col("doc_id") % 3 == 0, mk.leaf([F.col("doc_id"), F.col("lang"), F.upper("text")]))
    out = mk.checked(mk.manifest(docs(rows), COLUMNS, "doc_id", "lang", also={"altered": altered}), F.coalesce("altered", "leaf")).collect()
    assert {r.doc_id for r in out if not r.verified} == {i for i, _, _ in rows if i % 3 == 0}
    assert {r.folded_root for r in out if r.verified} == {out[0].root}


def test_null_is_not_empty_and_values_do_not_run_together(docs):
    out = docs([(1, None, ""), (2, "", None), (3, "1:a", "")]).select(mk.leaf([F.col("text"), F.col("lang")]).alias("h")).collect()
    assert [r.h for r in out].count(sha("-0:")) == 1 and {r.h for r in out} == {sha("-0:"), sha("0:-"), sha("3:1:a0:")}


def test_joins_share_one_partitioning(llm):
    """Seven joins and two exchanges, the second read again by each join; nothing is broadcast or gathered."""
    llm.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        nodes = llm.range(5000).select(F.lit("t").alias("x"), F.concat(F.lit("t"), (F.col("id") % 2).cast("string")).alias("tree"),
                                       F.expr("id div 2").alias("place"), F.lit(2500).cast("long").alias("size"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
        found = mk.with_siblings(nodes, 8)
        found.collect()
        final = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        llm.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert final.count("Join") == 7 and final.count("- Exchange hashpartitioning") == 2 and "SinglePartition" not in final
