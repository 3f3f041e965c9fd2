import random
import sys

import numpy as np
import pytest

from shelfmatch.llm import suffix_dedup as sd
from tests.llm.conftest import prose


def by_loop(rows, length=50):
    """Spans by a dictionary of all windows."""
    least = {}
    key = lambda i: sd.LAST if i is None else i
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        for p in range(len(t) - length + 1):
            w = t[p:p + length]
            least[w] = min(least.get(w, sd.LAST), key(i))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if least[t[p:p + length]] < key(i):
                gone[p:p + length] = b"\1" * length
        spans, p = [], 0
        while p < len(t):
            q = p
            while q < len(t) and gone[q] == gone[p]:
                q += 1
            if gone[p]:
                spans.append((p, q))
            p = q
        out.append((i, len(t), spans, bytes(c for c, g in zip(t, gone, strict=True) if not g)))
    return sorted(out, key=str)


def found(frame):
    return sorted(((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in frame.collect()), key=str)


def planted():
    """Passages that documents share whole, in part, edited, shifted, and next to each other."""
    rng = random.Random(8)
    passages = [prose(rng, n) for n in (10, 30, 60, 90)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(1, 5)):
            p = rng.choice(passages)
            a, b = sorted(rng.sample(range(len(p)), 2))
            kind = rng.randrange(5)
            parts.append([prose(rng, rng.randint(1, 20)), p, p[a:b], p[:a] + "#" + p[a + 1:], p + p[:b]][kind])
        rows.append((rng.randrange(10000), rng.choice(["", " ", "\x00"]).join(parts)))
    return rows


def test_rows(docs, awkward):
    rows = [*awkward, *planted(), (12, "a" * 49), (13, "a" * 50), (14, "\x00" * 200), (15, "\x00" * 60 + "b"), (16, "ab" * 100), (17, "ba" * 40)]
    assert found(sd.repeated_spans(docs(rows))) == by_loop(rows)
    assert sd.repeated_spans(docs([])).collect() == []


@pytest.mark.parametrize("length", [5, 26, 50])
def test_small_blocks_ranges_and_chunks(docs, monkeypatch, length):
    """Many blocks and ranges, and chunks that cut stretches and documents, give the same rows."""
    monkeypatch.setattr(sd, "CHUNK", 97)
    rows = planted()
    assert found(sd.repeated_spans(docs(rows), length, block_bytes=900, range_bytes=2000)) == by_loop(rows, length)


def test_merge_compares_no_known_prefix(monkeypatch):
    """The loser tree gives the sorted order and the common prefixes, and compares only bytes beyond those known."""
    rng = random.Random(3)
    strings = [bytes(rng.choice(b"ab\x00") for _ in range(20)) for _ in range(400)]
    data = np.frombuffer(b"".join(strings), np.uint8)
    places = np.arange(400) * 20
    cuts = [0, 7, 7, 150, 151, 390, 400]
    runs = [sd.Run(sd.front_coded(data, places[a:b], np.arange(a, b), 20), 20) for a, b in zip(cuts, cuts[1:]) if a < b]
    out = []
    for r, i, share in sd.merged(runs, 20):
        text = strings[runs[r].owner(i)]
        if out:
            common = next((k for k in range(20) if out[-1][k] != text[k]), 20)
            assert share == common
        out.append(text)
    assert out == sorted(strings)


def of_runs(strings, owners, cuts):
    """Entries of one range: a front-coded run of each part of ``strings``."""
    length = len(strings[0])
    data = np.frombuffer(b"".join(strings), np.uint8)
    places, owners = np.arange(len(strings)) * length, np.array(owners)
    return [(k, sd.front_coded(data, places[a:b], owners[a:b], length)) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]


def later_ones(strings, owners, cuts):
    """By block, the places of strings that a smaller owner has too."""
    least = {}
    for s, o in zip(strings, owners):
        least[s] = min(least.get(s, o), o)
    width = len(strings[0])
    found = [[k * width for k in range(a, b) if least[strings[k]] < owners[k]] for a, b in zip(cuts, cuts[1:])]
    return {k: at for k, at in enumerate(found) if at}


def test_a_merge_goes_by_arrays():
    """What a range does in Python doesn't grow with its strings."""
    rng = random.Random(4)
    strings = ["".join(rng.choice("abcd") for _ in range(8)).encode() for _ in range(60_000)]
    owners, cuts = [rng.randrange(500) for _ in strings], list(range(0, 60_001, 3_000))
    entries, calls = of_runs(strings, owners, cuts), [0]

    def count(frame, event, arg):
        calls[0] += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        found = list(sd.repeats(entries, 8))
    finally:
        sys.setprofile(None)
    assert {k: sd.unpack(data)[0].tolist() for k, data in found} == later_ones(strings, owners, cuts)
    assert calls[0] < len(strings) / 4


@pytest.mark.parametrize("ahead", [(1, 1, 1), (40, 2, 3), (500, 1, 1000)])
def test_parts_of_a_merge(monkeypatch, ahead):
    """Parts that end between equal strings, and runs that share no range of strings, give the same places and common prefixes."""
    for name, value in zip(("MERGED", "AHEAD", "STEP"), ahead):
        monkeypatch.setattr(sd, name, value)
    rng = random.Random(9)
    strings = [bytes(rng.choice(b"ab\x00") for _ in range(6)) for _ in range(900)] + [b"aaaaaa"] * 300 + [b"zz%04d" % k for k in range(200)]
    owners, cuts = [rng.randrange(40) for _ in strings], [0, 300, 301, 900, 1050, 1200, 1300, 1400]
    entries = of_runs(strings, owners, cuts)
    assert {k: sd.unpack(data)[0].tolist() for k, data in sd.repeats(entries, 6)} == later_ones(strings, owners, cuts)
    runs, order = [sd.Run(data, 6) for _, data in entries], []
    for r, i, share in sd.merged(runs, 6):
        text = strings[int(runs[r].at[i]) // 6]
        assert share == next((k for k in range(6) if not order or order[-1][k] != text[k]), 6)
        order.append(text)
    assert order == sorted(strings)


def test_long_stretches(docs):
    """Stretches longer than two windows are equal only if what is between their ends is."""
    rows = [(i, "xyz" * 60 + middle + "xyz" * 60) for i, middle in enumerate(["", "", "xyz", "q", "xy", "q", "xyzxyz" * 30])]
    rows += [(i + 10, ("-" * n + "=") * 5) for i, n in enumerate((80, 81, 80, 200, 30, 30))]
    assert found(sd.repeated_spans(docs(rows), block_bytes=500, range_bytes=700)) == by_loop(rows)


def test_one_run():
    data = np.frombuffer(b"banana", np.uint8)
    run = sd.Run(sd.front_coded(data, np.arange(4), np.zeros(4, np.int64), 3), 3)
    assert [share for _, _, share in sd.merged([run], 3)] == [0, 3, 0, 0]


def test_packing():
    arrays = [np.array([1, 5, 2], np.uint64), np.empty(0, np.int64), np.arange(300, dtype=np.uint32), np.array([3], np.uint8)]
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(sd.unpack(sd.pack(*arrays)), arrays, strict=True))


def test_texts_are_not_shuffled(docs, capsys):
    sd.repeated_spans(docs(planted()[:5])).explain("simple")
    shown = capsys.readouterr().out
    assert "Bucketed: true" in shown
    assert all("data" not in line or "rng" in line for line in shown.splitlines() if "Exchange" in line)


def test_ranges_are_even():
    rng = random.Random(12)
    text = prose(rng, 60_000).encode()
    sizes = [len(sd.unpack(data)[1]) for _, data in sd.Block(sd.pack_texts([1], [text]), 50).sent(16)]
    assert len(sizes) == 16 and max(sizes) < 1.2 * min(sizes)


def test_a_block_sends_no_more_than_it_holds():
    """However many ranges there are, rows are bounded by the block's own entries, and each meets its answer again."""
    rng = random.Random(12)
    block = sd.Block(sd.pack_texts([1], [prose(rng, 5_000).encode()]), 50)
    entries = len(block.firsts)
    for ranges in (1, 7, 1000, 6_000_000):
        sent = list(block.sent(ranges))
        assert len(sent) <= min(ranges, entries) and sum(len(sd.unpack(data)[1]) for _, data in sent) == entries
        anchors = np.concatenate([np.cumsum(sd.unpack(data)[0], dtype=np.uint64) for _, data in sent])
        assert (anchors == block.anchor[block.firsts]).all()
        held = [(r, sd.pack(np.full(len(sd.unpack(data)[1]), sd.HELD, np.uint8))) for r, data in sent[::2]]
        assert len(block.told(held, ranges)[0]) >= sum(len(sd.unpack(data)[0]) for _, data in held)


@pytest.mark.parametrize("length", [5, 8, 50])
def test_ranges_compare_all_bytes(length):
    rng = random.Random(length)
    text = bytes(rng.choice(b"\x00a\xff") if k % 90 > 60 else 97 for k in range(5000))
    data, at = np.frombuffer(text, np.uint8), np.arange(5000 - length)
    cuts = sorted({text[a:a + length] for a in rng.sample(range(5000 - length), 40)})
    to = sd.range_of(data, at, np.array(cuts, f"S{length}"), length)
    assert to.tolist() == [sum(c <= text[a:a + length] for c in cuts) for a in at.tolist()]
    assert sd.range_of(data, at, np.array([], f"S{length}"), length).tolist() == [0] * len(at)


@pytest.mark.parametrize("sorted_rows", [1 << 20, 700])
def test_a_shared_first_part_is_cut(docs, monkeypatch, sorted_rows):
    """Suffixes that begin alike are dealt by what follows, and cuts follow the number of ranges."""
    monkeypatch.setattr(sd, "SORTED", sorted_rows)
    rng = random.Random(5)
    rows = [(i, "the same beginning " + "".join(rng.choice("xyz") for _ in range(60))) for i in range(600)]
    blocks, _ = sd.packed_blocks(docs(rows), ("doc_id",), 2000, 50)
    count = blocks.count()
    cuts = sd.splitters(blocks, count, 50)
    assert cuts == sorted(set(cuts)) and 40 <= len(cuts) <= 60
    assert len({c[:8] for c in cuts}) < len(cuts)
    text = "".join(t for _, t in rows).encode()
    to = sd.range_of(np.frombuffer(text, np.uint8), np.arange(len(text) - 50), np.array(cuts, "S50"), 50)
    assert np.bincount(to).max() < 4 * len(to) / 50


def test_passage_in_a_third_of_all_documents(docs):
    rng = random.Random(6)
    passage = prose(rng, 40)
    rows = [(i, prose(rng, 4) + " " + passage + " " + prose(rng, 4) if i % 3 == 0 else prose(rng, 12)) for i in range(300)]
    assert found(sd.repeated_spans(docs(rows), block_bytes=3000, range_bytes=1500)) == by_loop(rows)
