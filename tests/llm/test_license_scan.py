import re

import pytest

from shelfmatch.llm.license_scan import NOTICES, PHRASES, Scanner, scan, word_line

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def base(text):
    words = WORD.findall(lower(text or ""))
    hits = sorted((i, label) for phrase, label in PHRASES.items() for i in range(len(words))
                  if words[i:i + len(phrase.split())] == phrase.split())
    return len(words), len(hits), hits[0][0] if hits else None, hits[-1][0] if hits else None, sorted({h[1] for h in hits})


TEXTS = ["Licensed under the Apache License, Version 2.0.", "apache-license APACHE  LICENSE mit license", "submit license", "The MIT\nLicense; cc by CC BY-NC",
         "gnu general public gnu general public license", "é mit license", "mitlicense", "ÀCC BY", "released under teh mit lisense today", "Á" * 10]


def test_base_rows(docs, awkward):
    rows = [*awkward, *[(100 + i, t) for i, t in enumerate(TEXTS)]]
    found = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in scan(docs(rows)).collect()), key=str)
    assert found == sorted(((i, *b[:4], ",".join(b[4])) for i, t in rows for b in [base(t)]), key=str)
    assert scan(docs([])).collect() == []


def test_labels_and_spans(docs):
    rows = [(1, "x Permission is herby granted, free of charge, to any persn obtaining a copy y"), (2, "Realeased under the MIT Lisence."), (3, "nothing of that kind")]
    found = {r.doc_id: r for r in scan(docs(rows)).collect()}
    assert found[1].labels == "mit" and found[1].base_labels == "" and 0.9 < found[1].score < 1
    span = found[1].spans[0]
    assert rows[0][1].encode()[span.start:span.stop].decode().startswith("Permission") and span.edits == 2
    assert found[2].labels == "mit" and found[3].labels == "" and found[3].score == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


@pytest.mark.parametrize("changed", ["gnu generl publc license", "gnx general public license", "gnu  generall public license", "gnu gnral pblic lcense"])
def test_seeds_lose_no_match(changed):
    """Every run of whole words within the edits is found, if only by an overlapping better one."""
    notice = "gnu general public license"
    line, _, _ = word_line(f"some words {changed} more words")
    words = line.decode().split()
    wanted = min(edits(notice, " ".join(words[i:j])) for i in range(len(words)) for j in range(i + 1, len(words) + 1))
    found = Scanner({}, {notice: "gpl"}, 10).fuzzy(line)
    assert ([f[3] for f in found] == [wanted]) if wanted <= 2 else not found


def test_notices_are_in_normal_form():
    assert all(WORD.findall(n) == n.split(" ") for n in [*NOTICES, *PHRASES])
