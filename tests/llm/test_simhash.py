import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from shelfmatch.llm.simhash import block_keys, components, links, near_duplicates, one_of_each_group
from tests.llm.conftest import prose


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values, distance=4):
    """Component of each value by union-find over all pairs."""
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in combinations(parent, 2):
        if (a ^ b).bit_count() <= distance:
            parent[find(a)] = find(b)
    return {v: find(v) for v in parent}


def by_loop(rows):
    prints = [fingerprint(t) for _, t in rows]
    root = roots(set(prints))
    least = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            least[root[p]] = min(least.get(root[p], i), i)
    return sorted(((i, f"{p:016x}", least.get(root[p])) for (i, _), p in zip(rows, prints, strict=True)), key=str)


def near_copies():
    rng = random.Random(2)
    text = prose(rng, 300).split()
    rows = []
    for i in range(40):
        own = list(text)
        for _ in range(i % 5):
            own[rng.randrange(len(own))] = "changed"
        rows.append((1000 + i, " ".join(own)))
    return rows


def test_rows(docs, awkward):
    rows = [*awkward, *near_copies(), (70, "One two"), (71, "one  TWO\n"), (72, "one two three four"), (73, "ÉCOLE École école")]
    assert sorted(map(tuple, near_duplicates(docs(rows)).collect()), key=str) == by_loop(rows)
    assert near_duplicates(docs([])).collect() == []


@pytest.mark.parametrize("tile", [8192, 5])
def test_links_give_the_components_of_all_pairs(llm, tile):
    rng = random.Random(9)
    values = {0, 1, (1 << 64) - 1}
    for _ in range(25):
        v = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 12, 30])):
            values.add(v)
            for _ in range(rng.randint(0, 5)):
                v ^= 1 << rng.randrange(64)
    signed = [int(np.array([v], np.uint64).view(np.int64)[0]) for v in values]
    edges = links(llm.createDataFrame([(v,) for v in signed], "fp long"), 4, 6, tile)
    found = {r.node % (1 << 64): r.root % (1 << 64) for r in components(edges).collect()}
    wanted = roots(values)
    groups = lambda m: {frozenset(k for k in m if m[k] == r) for r in m.values()}
    assert groups({v: found.get(v, v) for v in values}) == groups(wanted)


def test_close_pairs_share_a_key():
    rng = random.Random(4)
    keys = block_keys(6, 4)
    assert len(keys) == 15
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 4):
            b ^= 1 << bit
        assert any(a & m == b & m for _, m in keys)


def test_components_of_a_long_chain(llm):
    edges = llm.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (200, 201), (201, 200)], "a long, b long")
    found = {r.node: r.root for r in components(edges).collect()}
    assert found == {**{i: 0 for i in range(61)}, 200: 200, 201: 200}


def test_dense_groups_leave_few_links(llm):
    base = 0x123456789ABCDEF0
    values = [base ^ (1 << i) for i in range(60)]
    made = links(llm.createDataFrame([(int(np.array([v], np.uint64).view(np.int64)[0]),) for v in values], "fp long"))
    assert made.count() <= 15 * 60


def test_one_of_each_group(docs, awkward):
    rows = [*awkward, *near_copies(), (None, "words of rows without any id at all"), (None, "words of rows without any id at all"), (8, "another text of id 8")]
    out = one_of_each_group(docs(rows))
    assert out.columns == docs(rows).columns
    found = by_loop(rows)
    nameless = {p for i, p, c in found if c is None}
    kept = [r.doc_id for r in out.collect()]
    assert sorted(i for i in kept if i is not None) == sorted({i for i, _, c in found if i is not None and i == c})
    assert kept.count(None) == len(nameless) == 2
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[8] == min(t for i, t in rows if i == 8)
