import random
import re

import numpy as np
import pytest

from shelfmatch.llm import decontaminate as dc
from tests.llm.conftest import prose


def fold(text):
    return " ".join(text.lower().split())


def least_edits(item, text):
    """Edits of the best occurrence of ``item`` anywhere in ``text``, by the whole table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        before, row[0] = row[0], i
        for j, d in enumerate(text, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (c != d))
    return min(row)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, d in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (c != d))
    return row[-1]


def changed(rng, text, n):
    text = list(text)
    for _ in range(n):
        at = rng.randrange(len(text))
        kind = rng.randrange(3)
        if kind == 0:
            text[at] = "z"
        elif kind == 1:
            text.insert(at, "q")
        else:
            del text[at]
    return "".join(text)


@pytest.mark.parametrize("seed", range(8))
def test_every_occurrence_within_the_budget(seed):
    """Whatever the whole edit distance table finds within the budget is found, with spans that have those edits."""
    rng = random.Random(seed)
    items = [(i, prose(rng, rng.randint(4, 45))) for i in range(12)]
    index = dc.Index(items, dc.GRAM, 0.08)
    for _ in range(6):
        number, item = rng.choice(items)
        text = prose(rng, 30) + " " + changed(rng, item, rng.randint(0, 8)) + " " + prose(rng, 30)
        found = index.search(text)
        for number, item in items:
            folded, m = fold(item), len(fold(item))
            budget = dc.edit_budget(m, dc.GRAM, 0.08)
            least = least_edits(folded, fold(text))
            own = [f for f in found if f[0] == number]
            assert bool(own) == (least <= budget)
            assert not own or min(f[3] for f in own) == least
            for _, a, b, e in own:
                assert distance(folded, fold(text[a:b])) == e


def test_band_alignment_against_the_table():
    rng = random.Random(1)
    for _ in range(200):
        item = "".join(rng.choice("ab") for _ in range(rng.randint(1, 9)))
        text = "".join(rng.choice("ab") for _ in range(rng.randint(0, 12)))
        to = lambda s: np.array([ord(c) for c in s], np.uint32)
        hit = dc.align(to(item), to(text), -len(item), len(text), 3)
        least = least_edits(item, text)
        assert (hit is None) == (least > 3)
        if hit:
            assert hit[2] == least == distance(item, text[hit[0]:hit[1]])


def test_rows(docs, awkward, llm):
    rng = random.Random(6)
    items = [(1, prose(rng, 40)), (2, prose(rng, 20)), (2, prose(rng, 25)), (3, None), (4, ""), (5, " \n"), (6, "short one")]
    bench = llm.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    leak = prose(rng, 20) + "\n" + items[0][1].upper().replace(" ", "  ") + " " + prose(rng, 10) + items[0][1]
    rows = [*awkward, (50, leak), (50, leak), (51, "x" + items[1][1][:-3]), (52, prose(rng, 90)), (None, items[2][1]), (53, "a Short  One short one")]
    out = [tuple(r) for r in dc.contaminated(docs(rows), bench).collect()]
    assert sorted((r[0] or 0, r[1], r[4]) for r in out if r[0] != 51) == [(0, 2, 0), (50, 1, 0), (50, 1, 0), (50, 1, 0), (50, 1, 0), (53, 6, 0), (53, 6, 0)]
    spans = {fold(leak[a:b]) for i, _, a, b, _ in out if i == 50}
    assert spans == {fold(items[0][1])}
    assert [r[4] for r in out if r[0] == 51] == [3]
    assert dc.contaminated(docs([]), bench).collect() == []
    assert dc.contaminated(docs(rows), bench.limit(0)).collect() == []


def test_blocks_of_items(docs, llm):
    items = llm.createDataFrame([(i, f"item number {i} has words") for i in range(9)], "item_id long, text string")
    blocks = list(dc.item_blocks(items, 50))
    assert [i for b in blocks for i, _ in b] == list(range(9)) and len(blocks) > 3


def test_long_texts_in_chunks(monkeypatch):
    rng = random.Random(4)
    items = [(i, prose(rng, 20)) for i in range(5)]
    text = " ".join(prose(rng, 50) + " " + t for _, t in items)
    index = dc.Index(items, dc.GRAM, 0.05)
    whole = index.search(text)
    monkeypatch.setattr(dc, "CHUNK", 200)
    assert index.search(text) == whole and len(whole) == 5


def test_given_benchmark(llm):
    from shelfmatch.llm.common import table
    documents, bench = table(llm, "/root/testdata/sf0.01", "documents"), table(llm, "/root/testdata/sf0.01", "benchmark")
    wanted = documents.alias("d").join(bench.alias("b"), documents.text.contains(bench.text)).select("d.doc_id", "b.item_id")
    found = dc.contaminated(documents, bench)
    assert {tuple(r) for r in found.filter("edits = 0").select("doc_id", "item_id").collect()} == {tuple(r) for r in wanted.collect()}


@pytest.mark.parametrize("cut", [(0, 0.85), (0.15, 1), (0.12, 0.9)])
def test_parts_of_an_item(docs, llm, cut):
    """The greater part of an item, verbatim or with edits, is found and says which part; the document goes."""
    rng = random.Random(11)
    items = [(i, prose(rng, n)) for i, n in enumerate((45, 60, 400))]
    bench = llm.createDataFrame(items, "item_id long, text string")
    rows, part = [(99, prose(rng, 300))], {}
    for i, item in items:
        part[i] = (round(cut[0] * len(item)), round(cut[1] * len(item)))
        own = item[part[i][0]:part[i][1]].strip()
        rows += [(i, prose(rng, 20) + " \n" + own + "\n " + prose(rng, 20)), (10 + i, changed(rng, own, len(own) // 25))]
    found = dc.covered(docs(rows), bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(k + i, i) for i, _ in items for k in (0, 10)}
    texts = dict(rows)
    for r in found:
        item = fold(items[r.item_id][1])
        assert r.item_chars == len(item)
        text = re.sub(r"\s+", " ", texts[r.doc_id][r.start:r.stop].lower())
        assert distance(item[r.item_start:r.item_stop], text) == r.edits <= 0.08 * (r.item_stop - r.item_start)
        if r.doc_id < 10:  # edits let a window reach over the ends, less than a step
            assert abs(r.item_start - part[r.item_id][0]) < dc.STEP and abs(r.item_stop - part[r.item_id][1]) < dc.STEP
    assert [r.doc_id for r in dc.without_leaks(docs(rows), bench).collect()] == [99]


def repetitive(rng):
    """Text with runs of one character or a few, among words."""
    kinds = ["-" * rng.randint(5, 150), "=-" * rng.randint(4, 70), "| - " * rng.randint(3, 40), "abcde fghij klmno " * rng.randint(1, 8)]
    return prose(rng, rng.randint(0, 25)) + " " + rng.choice(kinds) + " " + prose(rng, rng.randint(0, 25)) + rng.choice(kinds)


@pytest.mark.parametrize("seed", range(6))
def test_bands_by_loop(seed):
    """Interval counts are those of single places, in texts with runs too."""
    rng = random.Random(seed)
    index = dc.Index([(i, repetitive(rng)[:rng.choice((12, 25, 60, 110, 300))]) for i in range(5)], 4, 0.08)
    text, _ = dc.folded(repetitive(rng) + " " + repetitive(rng))
    codes = dc.gram_codes(text, 4)
    wanted = set()
    for unit, item in enumerate(index.unit_item):
        first, m, edits = int(index.unit_start[unit]), int(index.unit_length[unit]), int(index.edits[unit])
        bands = {}
        for place, code in enumerate(dc.gram_codes(index.texts[item][first:first + m], 4)):
            for at in np.flatnonzero(codes == code).tolist():
                diagonal = at - place + m
                for band in range(max(0, diagonal // (edits + 1) - 2), diagonal // (edits + 1) + 1):
                    if band * (edits + 1) <= diagonal <= band * (edits + 1) + 2 * edits:
                        bands.setdefault(band, set()).add(place)
        wanted |= {(unit, b * (edits + 1) - m) for b, places in bands.items() if len(places) >= m - 4 + 1 - 4 * edits}
    found = [(unit, low + k * (int(index.edits[unit]) + 1)) for unit, low, n in index.bands(text) for k in range(n)]
    assert len(found) == len(set(found)) and set(found) == wanted


@pytest.mark.parametrize("seed", range(6))
def test_repetitive_texts_against_the_table(seed):
    """Items with runs are found where, and only where, the whole edit distance table finds them."""
    rng = random.Random(100 + seed)
    items = [(i, repetitive(rng)) for i in range(4)]
    index = dc.Index(items, dc.GRAM, 0.08)
    text = repetitive(rng) + changed(rng, items[0][1], 3) + "-" * rng.randint(0, 300) + items[1][1][:-5] + repetitive(rng)
    found = index.regions(text)
    for number, item in items:
        folded, m = fold(item), len(fold(item))
        least = least_edits(folded, fold(text))
        whole = [f for f in found if f[0] == number and f[4:6] == (0, m)]
        assert (least <= dc.edit_budget(m, dc.GRAM, 0.08)) <= bool(whole)
        assert not whole or min(f[3] for f in whole) >= least
        for _, a, b, e, first, last, _ in [f for f in found if f[0] == number]:
            assert distance(folded[first:last], re.sub(r"\s+", " ", text[a:b].lower())) == e <= max(0.08 * (last - first), 1)


def test_one_table_for_many_bands(monkeypatch):
    """Bands that go through one table give what they give one by one, but for overlapping finds."""
    rng = random.Random(8)
    for _ in range(60):
        to = lambda s: np.array([ord(c) for c in s], np.uint32)
        edits, bands = rng.randint(0, 2), rng.randint(4, 30)
        item, text = to(rng.choices("ab", k=rng.randint(4, 8) * (edits + 1))), to(rng.choices("ab", k=rng.randint(5, 60)))
        singles = [h for k in range(bands) if (h := dc.align(item, text, k * (edits + 1) - 3, k * (edits + 1) - 3 + 2 * edits, edits))]
        monkeypatch.setattr(dc, "PIECE", rng.choice((1, 10, 1 << 15)))
        at_once = list(dc.align_stretch(item, text, -3, bands, edits))
        assert bool(singles) == bool(at_once)
        assert min((h[2] for h in singles), default=9) == min((h[2] for h in at_once), default=9)
        for a, b, e in at_once:
            assert e == distance(item.tolist(), text[a:b].tolist())
        for a, b, e in singles:
            assert any(x < b + 2 * edits and a - 2 * edits < y for x, y, _ in at_once)


def test_long_runs_cost_no_more_than_their_length():
    """A run of 80 dashes in an item against 200,000 in a text: a band a place would be gigabytes and minutes."""
    import tracemalloc

    rng = random.Random(9)
    lead, end = prose(rng, 30), prose(rng, 30)
    index = dc.Index([(1, lead + "-" * 80 + end)], dc.GRAM, 0.08)
    text = lead + "-" * 200_000 + end + lead + "-" * 80 + end
    tracemalloc.start()
    found = index.regions(text)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [f for f in found if f[3] == 0 and f[4:6] == (0, f[6])] and most < 200 << 20
