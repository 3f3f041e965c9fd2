import hashlib

from shelfmatch.llm import digest as dg


def by_loop(rows):
    order = sorted([(i, t or "") for i, t in rows], key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        changed = dg.edited(t, after).encode()
        mine, other, following = dg.digest(t.encode()), dg.digest(changed), dg.digest(after.encode())
        out.append((i, len(t), hashlib.sha256(changed).hexdigest(), mine.hex(), other.hex(), dg.likeness(mine, other), dg.likeness(mine, following)))
    return out


def test_rows(docs, awkward, llm):
    assert sorted(map(tuple, dg.compare_with_edits(docs(awkward)).collect()), key=str) == sorted(by_loop(awkward), key=str)


def test_many_blocks(docs):
    rows = [((i * 7919) % 3001, f"text {i} " * (i % 7)) for i in range(1200)]
    assert sorted(map(tuple, dg.compare_with_edits(docs(rows, 5)).collect())) == sorted(by_loop(rows))


def test_one_and_none(docs):
    assert [r.near_next for r in dg.compare_with_edits(docs([(4, "only this one")])).collect()] == [1.0]
    assert dg.compare_with_edits(docs([])).collect() == []


def test_equal_ids_of_unequal_texts(docs):
    rows = [(1, "a" * 8), (1, "b" * 8), (1, None), (2, "c" * 8)]
    found = dg.compare_with_edits(docs(rows)).collect()
    assert len(found) == 4 and sum(r.n_chars for r in found) == 24


def test_digests():
    text = ("some words that repeat, and others that do not " * 30).encode()
    assert len(dg.digest(text)) == 34 and dg.likeness(dg.digest(text), dg.digest(text)) == 1.0
    assert dg.likeness(dg.digest(text), dg.digest(text + b" tail")) > 0.8 > 0.5 > dg.likeness(dg.digest(text), dg.digest(bytes(range(256)) * 9))
    assert sum(dg.bucket_counts(text)) == len(text) - 2 and not dg.bucket_counts(b"ab").any()


def test_long_texts_in_pieces(monkeypatch):
    data = bytes(i * i % 251 for i in range(5000))
    whole = dg.bucket_counts(data).tolist()
    monkeypatch.setattr(dg, "_CHUNK", 64)
    assert dg.bucket_counts(data).tolist() == whole


def test_fingerprints(docs):
    found = {r.doc_id: r.fingerprint for r in dg.fingerprints(docs([(1, "same text"), (2, "same text"), (3, None)])).collect()}
    assert found[1] == found[2] != found[3] == dg.digest(b"").hex()
