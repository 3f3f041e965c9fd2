import zlib
from collections import Counter

import pytest

from shelfmatch.llm.common import held_out, table
from shelfmatch.llm.language import LEAST, Profiles, gram_counts, identify, known_language, language_ids, learn_profiles, letter_table, ranked
from pyspark.sql import functions as F

LETTERS = letter_table()


def by_loop(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    return Counter(w[i:i + n] for w in (f" {w} " for w in words) for n in (1, 2, 3) for i in range(len(w) - n + 1) if w[i:i + n] != " ")


def code(gram):
    value = 0
    for c in gram:
        value = value << 21 | ord(c)
    return value


@pytest.mark.parametrize("text", ["", "  1 2", "Ab, a b.", "x", "né ÜBER über 𝔘𝔫 a1b", "ab" * 5000 + " c"])
def test_grams(text):
    codes, counts = gram_counts(text, LETTERS)
    wanted = {code(g): n for g, n in by_loop(text).items()}
    assert dict(zip(codes.tolist(), counts.tolist(), strict=True)) == wanted


def test_pieces_of_long_texts(monkeypatch):
    text = "alpha bé 12 gamma " * 400
    whole = gram_counts(text, LETTERS)
    monkeypatch.setattr("shelfmatch.llm.language._CHUNK", 37)
    parts = gram_counts(text, LETTERS)
    assert [a.tolist() for a in whole] == [a.tolist() for a in parts]


def test_ties_rank_by_code():
    codes, counts = gram_counts("b a c", LETTERS)
    order = ranked(codes, counts, 3).tolist()
    assert order == sorted(codes[counts == counts.max()].tolist())[:3]


def test_distance_by_loop():
    profiles = {"xx": [code(g) for g in ("a", "b", " a", "ab")], "yy": [code(g) for g in ("b", "a", "zz", "z")]}
    model = Profiles(profiles, 4)
    mine = ranked(*gram_counts("ab ab b", LETTERS), 4).tolist()
    far = {lang: sum(min(4, abs(i - own.index(g))) if g in own else 4 for i, g in enumerate(mine)) for lang, own in profiles.items()}
    name, score = model.best("ab ab b")
    assert name == min(sorted(far), key=far.get) and score == pytest.approx(1 - far[name] / (4 * len(mine)))


def test_awkward(docs, awkward):
    rows = [(i, t, "en" if i is None or i % 2 else None) for i, t in awkward]
    out = language_ids(docs(rows)).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(i) for i, _ in awkward)
    for r in out:
        assert r.held_out == (zlib.crc32(("null" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    assert {r.doc_id: r.lang_pred for r in out}[2] == "und" and {r.doc_id: r.lang_pred for r in out}[3] == "und"
    assert language_ids(docs([])).collect() == []


def test_no_profiles(docs):
    assert [r.lang_pred for r in identify(docs([(1, "word")]), {}).collect()] == ["und"]


def test_held_out_accuracy(llm):
    documents = table(llm, "/root/testdata/sf0.01", "documents")
    found = language_ids(documents).join(documents.select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null")
    assert found.filter("lang = lang_pred").count() >= 0.97 * found.count()


def test_only_rows_not_held_out_teach(docs):
    rows = [(i, "abc abc", "aa") for i in range(30)] + [(i, "xyz xyz", "bb") for i in range(30, 60)]
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    poisoned = [(i, t, "cc") if (i, t, lang) in held else (i, t, lang) for i, t, lang in rows]
    profiles = learn_profiles(docs(poisoned).filter(~held_out(F.col("doc_id"))))
    assert sorted(profiles) == ["aa", "bb"]


def test_copies_teach_once(docs):
    rows = [(i, "abc abd", "aa") for i in range(200)] + [(300 + i, f"xyz {'xyz ' * (i % 3)}x", "aa") for i in range(40)]
    few = list({(t, lang): (i, t, lang) for i, t, lang in rows}.values())
    assert learn_profiles(docs(rows)) == learn_profiles(docs(few))


def test_profiles_by_loop(docs):
    rows = [(1, "abc ab", "aa"), (2, "xyz y", "bb"), (3, "b", "aa"), (4, None, "bb"), (5, "12", "cc")]
    wanted = {lang: sum((by_loop(t or "") for _, t, own in rows if own == lang), Counter()) for lang in ("aa", "bb", "cc")}
    assert learn_profiles(docs(rows), 6) == {
        lang: [c for c, _ in sorted(((code(g), n) for g, n in counts.items()), key=lambda x: (-x[1], x[0]))[:6]] for lang, counts in wanted.items()}


JUNK = ["это проверка определения языка", "这是一个关于语言识别的测试文件", " ".join(f"{i * 7919 ** 9:x}" for i in range(300)),
        " ".join("".join("qwxzkjvb"[(i * j + j * j) % 8] for j in range(3, 11)) for i in range(300))]


def test_only_texts_in_a_learned_language_stay(llm):
    """Whole given table: what is predicted with the least score stays, and no text that has letters of its language is lost."""
    documents = table(llm, "/root/testdata/sf0.01", "documents")
    junk = llm.createDataFrame([(-1 - k, t, None, None, len(t)) for k, t in enumerate(JUNK)], documents.schema)
    both = documents.unionByName(junk)
    kept = {r.doc_id for r in known_language(both).select("doc_id").collect()}
    told = language_ids(both).collect()
    assert kept == {r.doc_id for r in told if r.lang_pred != "und" and r.score >= LEAST}
    assert kept == {r.doc_id for r in documents.collect() if any(c.isalpha() for c in r.text or "")}
    spanish = {r.doc_id for r in known_language(both, languages=("es",)).select("doc_id").collect()}
    assert spanish == {r.doc_id for r in told if r.lang_pred == "es" and r.score >= LEAST}
