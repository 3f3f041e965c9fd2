import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfmatch.llm import chunk_dedup as cd
from shelfmatch.llm.common import table
from tests.llm.conftest import prose

SMALL = {"least": 32, "most": 200, "mean": 16}


def by_loop(rows):
    """Without ``kept``: which of several equal rows stays is not for the rows to tell."""
    sizes = Counter(t or "" for _, t in rows)
    last = {}
    for i, t in rows:
        if i is not None:
            last[t or ""] = max(i, last.get(t or "", i))
    return sorted(((i, last.get(t or ""), sizes[t or ""], hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows), key=str)


def check(out, rows):
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out), key=str) == by_loop(rows)
    stays = Counter(r.text_sha256 for r in out if r.kept)
    assert set(stays) == {r.text_sha256 for r in out} and set(stays.values()) <= {1}
    assert all(r.doc_id == r.keep_id for r in out if r.kept)


def edits():
    rng = random.Random(4)
    text = prose(rng, 4000)
    rows = [(100, text), (101, text), (102, text + "x"), (103, "x" + text), (104, text[:2000] + text[2001:]), (105, text[:700]), (106, text[700:])]
    return rows + [(107, "copy") for _ in range(50)] + [(200 + i, "copy") for i in range(50)] + [(None, "nobody's"), (None, "nobody's")]


@pytest.mark.parametrize("sizes", [{}, SMALL])
def test_rows(docs, awkward, sizes):
    rows = awkward + edits()
    check(cd.exact_groups(docs(rows), **sizes).collect(), rows)


def test_none(docs):
    assert cd.exact_groups(docs([])).collect() == []


def test_short_identifiers_are_found_out(docs, awkward):
    """Four bits can't tell the chunks apart: they are widened until they do, and nothing changes."""
    rows = awkward + edits()
    assert cd.verified_bits(docs(rows), 4, **SMALL) > 4
    check(cd.exact_groups(docs(rows), 4, **SMALL).collect(), rows)
    assert cd.verified_bits(docs([(1, "a"), (2, "a"), (3, None)]), 4) == 4


def test_normalised(docs):
    out = cd.exact_groups(docs([(1, "One"), (2, "one"), (3, None)]), normalised=F.lower("text")).collect()
    assert {r.doc_id: r.keep_id for r in out} == {1: 2, 2: 2, 3: 3}
    assert {r.text_sha256 for r in out if r.doc_id < 3} == {hashlib.sha256(b"one").hexdigest()}


def test_given_documents(llm):
    docs = table(llm, "/root/testdata/sf0.01", "documents")
    check(cd.exact_groups(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_chunks_are_the_text_and_within_bounds():
    rng = random.Random(3)
    texts = [prose(rng, n) for n in (0, 1, 9, 700, 3000)] + ["", "a" * 5000, "é" * 900]
    for sizes in ({}, SMALL):
        least, most = sizes.get("least", cd.LEAST), sizes.get("most", cd.MOST)
        for text, own in zip(texts, cd.chunked(pa.array(texts), **sizes), strict=True):
            assert b"".join(own) == text.encode()
            assert all(least <= len(c) <= most for c in own[:-1]) and all(0 < len(c) <= most for c in own)


def test_a_text_is_cut_alike_wherever_it_lies():
    rng = random.Random(6)
    text = prose(rng, 5000)
    alone, = cd.chunked(pa.array([text]), **SMALL)
    _, behind, _ = cd.chunked(pa.array([prose(rng, 77), text, "end"]), **SMALL)
    part, = cd.chunked(pa.array(["no", text, "sliced"]).slice(1, 1), **SMALL)
    assert alone == behind == part and len(alone) > 100
    moved, = cd.chunked(pa.array(["some words in front " + text]), **SMALL)
    assert len(set(map(bytes, moved)) & set(map(bytes, alone))) > 0.9 * len(alone)


def test_rolling_by_loop():
    data = np.random.default_rng(1).integers(0, 256, 200, np.uint8)
    gear = cd._GEAR.astype(object)
    wanted = [sum(int(gear[data[i - k]]) << k for k in range(min(32, i + 1))) % (1 << 32) for i in range(200)]
    assert cd.rolling(data).tolist() == wanted


def test_a_long_document_leaves_in_chunks(docs):
    rows = [(i, prose(random.Random(i), 3000)) for i in range(3)] * 4
    chunks = cd.distinct_chunks(docs(rows)).collect()
    assert max(len(r.chunk) for r in chunks) <= cd.MOST
    assert sum(len(r.chunk) for r in chunks) <= sum(len(t.encode()) for t in {t for _, t in rows})
