import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmatch.llm import periodic_runs as pr
from shelfmatch.llm.common import table
from shelfmatch.llm.queries import op11_periodic_runs
from tests.llm.conftest import prose


def by_loop(words, least=24, times=3):
    """Every period in turn: stretches in which words that far apart are equal, unless a smaller period does it too."""
    known = {}
    x = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    found = {}
    for q in range(1, len(x) // times + 1):
        same = np.concatenate(([0], (x[q:] == x[:-q]).astype(np.int8), [0]))
        edges = np.flatnonzero(np.diff(same))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            size = b - a + q
            if size >= max(least, times * q):
                found.setdefault((a, size), q)  # the smallest period comes first
    return sorted(((a, size, q) for (a, size), q in found.items()), key=lambda r: (r[0], r[2]))


def words_of(text):
    return (text or "").encode().split()


def left(words, runs):
    gone = {i for a, size, q in runs for i in range(a + q, a + size)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


def check(out, rows, **sizes):
    wanted = []
    for i, t in rows:
        runs = by_loop(words_of(t), **sizes)
        wanted.append((i, tuple(runs), left(words_of(t), runs)))
    assert sorted(((r.doc_id, tuple(map(tuple, r.runs)), r.collapsed) for r in out.collect()), key=str) == sorted(wanted, key=str)


def loops():
    rng = random.Random(8)
    rows = []
    for i in range(60):
        words = prose(rng, rng.randint(0, 30)).split()
        for _ in range(rng.randint(1, 4)):
            unit = [rng.choice("abc") for _ in range(rng.randint(1, 40))]
            words += unit * rng.randint(1, 30) + unit[:rng.randint(0, len(unit))] + prose(rng, rng.randint(0, 3)).split()
        rows.append((100 + i, " ".join(words)))
    return rows


def test_rows(docs, awkward):
    rows = [*awkward, *loops(), (300, "la " * 23), (301, "la " * 24), (302, "la\x0bla\x1cla " * 30), (303, "x " * 5 + "y z " * 400 + "y")]
    check(pr.periodic_runs(docs(rows)), rows)
    assert pr.periodic_runs(docs([])).collect() == []


@pytest.mark.parametrize("least,times", [(24, 3), (2, 3), (5, 4), (48, 3), (7, 6)])
def test_short_alphabets(least, times):
    rng = random.Random(least)
    texts = [[rng.choice([b"a", b"b", b"c"][:rng.randint(1, 3)]) for _ in range(rng.randint(0, 90))] for _ in range(400)]
    texts += [[b"a"] * n for n in range(60)] + [([b"a"] * 7 + [b"b"]) * 9, ([b"a", b"b"] * 8 + [b"c"]) * 5]
    assert list(pr.runs_of_texts(texts, least, times)) == [by_loop(t, least, times) for t in texts]


def test_neighbours_in_a_batch_do_not_meet():
    texts = [[b"a"] * 20, [b"a"] * 20, [], [b"a"] * 30, [], [b"a"] * 3]
    assert list(pr.runs_of_texts(texts)) == [[], [], [], [(0, 30, 1)], [], []]
    assert list(pr.runs_of_texts([])) == []


def test_bounds_are_stated():
    with pytest.raises(ValueError):
        pr.runs_of(np.arange(4), times=2)


def test_strongest(docs):
    struct = "struct<start:long,length:long,period:long>"
    rows = [(1, [(5, 30, 7), (9, 60, 14), (0, 24, 8)], (5, 30, 7)), (2, [(3, 31, 7), (9, 60, 14)], (3, 31, 7)), (3, [], None),
            (4, [(2, 24, 1), (2, 48, 2)], (2, 24, 1))]
    spark = docs([]).sparkSession
    given = spark.createDataFrame([r[:2] for r in rows], f"id long, runs array<{struct}>")
    assert {r.id: r.s and tuple(r.s) for r in given.select("id", pr.strongest(F.col("runs")).alias("s")).collect()} == {i: w for i, _, w in rows}


def query_by_loop(rows):
    out = []
    for i, t in rows:
        words = words_of(t)
        n, h = len(words), zlib.crc32(str(i).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        runs = by_loop(words)
        top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        out.append((i, len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
                    hashlib.sha256("".join(f"{a},{s},{q}\n" for a, s, q in runs).encode()).hexdigest(),
                    hashlib.sha256(left(words, runs).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_by_brute_force(llm, size):
    rows = [(r.doc_id, r.text) for r in table(llm, f"/root/testdata/{size}", "documents").collect()]
    out = op11_periodic_runs(llm, f"/root/testdata/{size}")
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    found = sorted(map(tuple, out.collect()))
    assert found == query_by_loop(rows)
    assert sum(r[1] > 0 for r in found) > len(rows) / 20
