import random

import pytest
from pyspark.sql import functions as F

from shelfmatch.llm import packing as pk
from tests.llm.conftest import prose

SIZES = (8, 16, 32)


def by_loop(lengths, sizes, cost):
    """The same rules with linear searches."""
    rest, bins, at = sorted(lengths, reverse=True), [], []
    while rest:
        n = rest.pop(0)
        fits = [(room, b) for b, (room, _) in enumerate(bins) if room >= n]
        if fits:
            b = min(fits)[1]
        else:
            def price(s):
                room, held = s - n, n
                for other in rest:
                    if other <= room:
                        room, held = room - other, held + other
                return cost(s) / held, s
            b = len(bins)
            bins.append((min((s for s in sizes if s >= n), key=price), 0))
        bins[b] = bins[b][0] - n, bins[b][1] + n
        at.append(b)
    return at, [min(s for s in sizes if s >= used) for _, used in bins]


@pytest.mark.parametrize("seed", range(25))
def test_best_fit(seed):
    rng = random.Random(seed)
    lengths = sorted((rng.randint(1, 32) for _ in range(rng.randint(0, 120))), reverse=True)
    cost = lambda s: s + seed % 4 * 3
    assert pk.best_fit(lengths, SIZES, cost) == by_loop(lengths, SIZES, cost)


def test_sizes_are_chosen_jointly():
    at, sizes = pk.best_fit([5, 5, 5, 1], SIZES, lambda s: s + 4)
    assert at == [0, 0, 0, 0] and sizes == [16]
    assert pk.best_fit([20, 3], SIZES, lambda s: s)[1] == [32]
    assert pk.best_fit([8, 8], SIZES, lambda s: s)[1] == [8, 8]


def check(rows, lengths, sizes):
    """Every token of every row once, in sequences that hold them without gaps and are no longer than needed."""
    pieces, bins = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append((r.start, r.n_tokens))
        if r.sequence is not None:
            bins.setdefault((r.sequence, r.capacity), []).append((r.place, r.n_tokens))
    for (_, capacity), own in bins.items():
        at = 0
        for place, n in sorted(own):
            assert place == at and n > 0
            at += n
        assert capacity == min(s for s in sizes if s >= at)
    assert len({s for s, _ in bins}) == len(bins)
    for i, wanted in lengths.items():
        starts = sorted(pieces[i])
        assert sum(n for _, n in starts) == sum(wanted)
        if len(wanted) == 1:
            assert [s for s, _ in starts] == [sum(n for _, n in starts[:k]) for k in range(len(starts))]


def test_rows(docs, awkward):
    rows = [*awkward, *[(100 + i, prose(random.Random(i), i % 50)) for i in range(200)]]
    lengths = {}
    for i, t in rows:
        lengths.setdefault(i, []).append(len((t or "").split()))
    for group in (50, 10 ** 6):
        out = pk.pack(docs(rows), pk.word_count(F.col("text")), SIZES, 4, group).collect()
        check(out, lengths, SIZES)
    assert {r.doc_id for r in out} == set(lengths)
    assert pk.pack(docs([]), pk.word_count(F.col("text"))).collect() == []


def test_groups_follow_the_rule(docs):
    """One group: the lengths and sizes are those of the plain rule."""
    rows = [(i, "w " * random.Random(i).randint(1, 31)) for i in range(150)]
    out = pk.pack(docs(rows), pk.word_count(F.col("text")), SIZES, 4).collect()
    lengths = sorted((len(t.split()) for _, t in rows), reverse=True)
    _, sizes = by_loop(lengths, SIZES, lambda s: s + 4)
    assert sorted({r.sequence: r.capacity for r in out}.values()) == sorted(sizes)


def test_waste_is_small(llm):
    from shelfmatch.llm.common import table
    out = pk.pack(table(llm, "/root/testdata/sf0.01", "documents"), pk.word_count(F.col("text"))).collect()
    held = sum(r.n_tokens for r in out)
    assert held > 0.97 * sum({r.sequence: r.capacity for r in out if r.sequence}.values())
