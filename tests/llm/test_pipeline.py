import random


import corpus_pipeline as cp
from shelfmatch.llm import decontaminate as dc
from shelfmatch.llm import language
from shelfmatch.llm.common import table
from tests.llm import test_decontaminate, test_packing, test_simhash, test_suffix_dedup
from tests.llm.conftest import prose

DATA = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_are_named_in_order():
    assert [n for n, _ in cp.STAGES] == ["language", "near_duplicates", "repeated_passages", "decontamination", "packing"]


def test_given_documents_by_brute_force(llm):
    """Each stage's output from its own input, by plain loops, over all given documents."""
    docs = table(llm, DATA, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    kept = {}
    for name, stage in cp.STAGES[:-1]:
        docs = llm.createDataFrame(stage(llm, docs, DATA).collect(), docs.schema)
        assert docs.columns == COLUMNS
        kept[name] = {r.doc_id: r for r in docs.collect()}
    told = language.language_ids(table(llm, DATA, "documents")).collect()
    assert set(kept["language"]) == {r.doc_id for r in told if r.lang_pred != "und" and r.score >= language.LEAST}
    groups = test_simhash.by_loop([(i, r.text) for i, r in kept["language"].items()])
    assert set(kept["near_duplicates"]) == {i for i, _, c in groups if i == c}
    spans = test_suffix_dedup.by_loop([(i, r.text) for i, r in kept["near_duplicates"].items()])
    for i, n, cut, left in spans:
        if n and not left:
            assert i not in kept["repeated_passages"]
            continue
        row = kept["repeated_passages"][i]
        assert row.n_chars == len(row.text) and (row.text.encode() == left if row.text.isascii() else len(row.text.encode()) >= len(left))
        assert (row.lang, row.source) == (rows[i].lang, rows[i].source)
    items = [test_decontaminate.fold(r.text) for r in table(llm, DATA, "benchmark").collect()]
    gone = set(kept["repeated_passages"]) - set(kept["decontamination"])
    for i, r in kept["repeated_passages"].items():
        text = test_decontaminate.fold(r.text)
        assert (i in gone) or not any(t in text for t in items)
        if i in gone:
            assert any(test_decontaminate.least_edits(t, text) <= dc.edit_budget(len(t), dc.GRAM, dc.EDIT_RATE) for t in items)
    out = cp.STAGES[-1][1](llm, docs, DATA).collect()
    test_packing.check(out, {i: [len(r.text.split())] for i, r in kept["decontamination"].items()}, (512, 1024, 2048, 4096))
    assert sorted(map(str, cp.run(llm, DATA).select("doc_id", "piece", "n_tokens").collect())) == sorted(
        str(r) for r in llm.createDataFrame([(r.doc_id, r.piece, r.n_tokens) for r in out], "doc_id long, piece long, n_tokens long").collect())


def test_awkward_rows_in_every_stage(docs, awkward):
    rng = random.Random(1)
    shared = prose(rng, 30)
    rows = [*awkward, (60, "start " + shared), (61, shared + " end"), (62, shared), (None, None), (None, "again one without id"), (63, "é" + shared)]
    for name, stage in cp.STAGES:
        given = docs(rows)
        out = stage(given.sparkSession, given, DATA)
        if name != "packing":
            assert out.columns == given.columns
            assert [f.dataType for f in out.schema] == [f.dataType for f in given.schema]
        found = [r.doc_id for r in out.collect()]
        assert 10 in found and 11 in found
        empty = docs([])
        assert stage(empty.sparkSession, empty, DATA).collect() == []
        if name == "near_duplicates":
            assert sorted(i for i in found if i is not None and 0 < i < 7) == [1, 4, 5] and found.count(None) == 2
        if name == "repeated_passages":
            texts = {r.doc_id: r.text for r in out.collect()}
            assert 62 not in texts and texts[61] == " end" and texts[60] == "start " + shared and texts[63] == "é" and texts[1] is None
        if name == "language":
            assert not {1, 2, 3} & set(found) and found.count(5) == 2 and found.count(None) == 2


def test_no_language_named(docs):
    given = docs([(1, "words here"), (2, "12 3"), (3, None)])
    assert [r.doc_id for r in cp.known_language(given.sparkSession, given, DATA).collect()] == [1]
