import random
import zlib
from itertools import product

import numpy as np
import pytest

from shelfmatch.llm import toxicity as tx
from shelfmatch.llm.common import table
from tests.llm.conftest import prose


def chain(score, steps):
    """Marginals by summing over all taggings."""
    total, toxic = 0.0, np.zeros(len(score))
    for tags in product((0, 1), repeat=len(score)):
        w = np.exp(sum(s for s, t in zip(score, tags, strict=True) if t) + sum(steps[a, b] for a, b in zip(tags, tags[1:], strict=False)))
        total += w
        toxic += w * np.array(tags)
    return toxic / total


def test_marginals_against_all_taggings(monkeypatch):
    rng = np.random.default_rng(3)
    steps = rng.normal(size=(2, 2))
    lengths = [3, 1, 7, 0, 9, 2]
    scores = [rng.normal(size=n) * 2 for n in lengths]
    flat = np.concatenate([np.append(s, 0.0) for s in scores])
    cut = np.concatenate([np.append(np.zeros(n, bool), True) for n in lengths])
    for segment in (4, 512):
        monkeypatch.setattr(tx, "_SEGMENT", segment)
        found = tx.marginals(flat, cut, steps)
        at = 0
        for s in scores:
            assert found[at:at + len(s)] == pytest.approx(chain(s, steps) if len(s) else [])
            at += len(s) + 1


def test_gradient_against_differences():
    rng = np.random.default_rng(1)
    model = tx.Model({}, rng.normal(size=1), rng.normal(size=4), rng.normal(size=4), rng.normal(size=4), rng.normal(size=(2, 2)), (0, 0, 0))
    ids, tags, lengths = rng.integers(0, 4, (3, 5)), rng.integers(0, 2, (3, 5)), np.array([5, 2, 4])

    def likelihood():
        out = 0.0
        for row, tag, n in zip(ids, tags, lengths, strict=True):
            w, t = row[:n], tag[:n]
            score = [model.any[0] + model.here[w[i]] + (model.before[w[i - 1]] if i else 0) + (model.after[w[i + 1]] if i + 1 < n else 0) for i in range(n)]
            path = lambda t: sum(s for s, x in zip(score, t, strict=True) if x) + sum(model.steps[a, b] for a, b in zip(t, t[1:], strict=False))
            out += path(t) - np.log(sum(np.exp(path(p)) for p in product((0, 1), repeat=int(n))))
        return out

    found = tx.likelihood_gradient(model, ids, tags, lengths)
    for weights, gradient in zip((model.any, model.here, model.before, model.after, model.steps), found, strict=True):
        for at in np.ndindex(weights.shape):
            was = weights[at]
            weights[at] = was + 1e-5
            up = likelihood()
            weights[at] = was - 1e-5
            down = likelihood()
            weights[at] = was
            assert gradient[at] == pytest.approx((up - down) / 2e-5, abs=1e-4)


def made(n=400):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        words, toxic = prose(rng, 40).split(), i % 3 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(40)] = rng.choice(["Vile", "rotten"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic), "x", "x"))
    return rows, labels


def test_rows_and_spans(docs, awkward, llm):
    rows, labels = made()
    more = [(10_000 + (i or 0), t) for i, t in awkward]
    extra = [(None, 1, "x", "x"), (7, None, "x", "x"), (3, 1, "x", "x"), (3, 1, "x", "x")]
    marked = llm.createDataFrame(labels + extra, "doc_id long, toxic int, text string, score string")
    out = tx.toxicity(docs([*rows, *more, (20_000, "ÄÖ fine words, then VILE rotten ones")]), marked).collect()
    assert len(out) == len(rows) + len(more) + 1
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    truth = {i: t for i, t, *_ in labels}
    assert all(r.predicted == truth[r.doc_id] for r in out if r.doc_id in truth)
    assert all(r.predicted == 0 and not r.spans for r in out if 10_000 <= r.doc_id < 20_000)
    last = next(r for r in out if r.doc_id == 20_000)
    assert [(s.start, s.stop) for s in last.spans] == [(20, 31)]


def test_held_out_labels_teach_nothing(docs, llm):
    rows, labels = made(120)
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t, *x) for i, t, *x in labels]
    schema = "doc_id long, toxic int, text string, score string"
    a, b = [sorted((r.doc_id, r.score) for r in tx.toxicity(docs(rows), llm.createDataFrame(x, schema)).collect()) for x in (labels, flipped)]
    assert a == b


def test_no_labels_and_no_rows(docs, llm):
    none = llm.createDataFrame([], "doc_id long, toxic int")
    assert [tuple(r)[2:4] for r in tx.toxicity(docs([(1, "a")]), none).collect()] == [(0.0, 0)]
    assert tx.toxicity(docs([]), none).collect() == []


def test_held_out_accuracy(llm):
    documents, labels = [table(llm, "/root/testdata/sf0.1", n) for n in ("documents", "labels")]
    found = tx.toxicity(documents, labels).join(labels.select("doc_id", "toxic"), "doc_id").filter("held_out")
    right = found.filter("predicted = toxic").count()
    assert right >= 0.97 * found.count()


def test_labels_of_other_documents_take_no_share(docs, llm):
    given = docs([(i, f"text {i}") for i in range(60)])
    own = [(i, i % 2) for i in range(60)]
    others = [(1000 + i, int(i % 10 == 0)) for i in range(5000)]
    few, many = (llm.createDataFrame(rows, "doc_id long, toxic int") for rows in (own, own + others))
    assert sorted(tx.sample_of(given, many, 100)) == sorted(tx.sample_of(given, few, 100)) == sorted((f"text {i}", i % 2) for i in range(60))
