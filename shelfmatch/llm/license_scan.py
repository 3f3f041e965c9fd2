"""License notices in texts: exact phrases, and short notices with a bounded number of edits.

Texts are read as words with one space between. A notice that may have k edits is cut into k + 1 pieces: a match with at
most k edits leaves one piece untouched, so the exact places of the pieces are the only candidates. Around each, the regex
library's bounded-error matching verifies the notice between word ends and gives the span and the edits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from shelfmatch.llm.common import by_text, doc_texts

#: Exact phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices that are searched with edits, one for every ten characters, and their labels.
NOTICES = {
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "licensed under the apache license": "apache",
    "apache license version 2 0": "apache",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license version": "mpl",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
}
CHARS_PER_EDIT = 10

_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def word_line(text: str) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of a text with one space between and at both ends, each byte's place in the UTF-8 text, word starts.

    A-Z is lower-cased; words are runs of digits, letters a-z and all bytes from 0x80 on.
    """
    data = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    word = _WORD[data]
    keep = word.copy()
    keep[1:] |= word[:-1]
    places = np.flatnonzero(keep)
    line = np.where(word[places], data[places], 32).astype(np.uint8)
    if len(line) and line[-1] != 32:
        line, places = np.append(line, np.uint8(32)), np.append(places, len(data))
    line = np.concatenate((np.array([32], np.uint8), line))
    places = np.concatenate(([-1], places))
    starts = np.flatnonzero((line[1:] != 32) & (line[:-1] == 32)) + 1
    return line.tobytes(), places, starts


def pieces(notice: bytes, edits: int) -> list[tuple[int, bytes]]:
    """``edits + 1`` pieces of near equal length and their offsets."""
    cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def all_places(line: bytes, part: bytes) -> list[int]:
    found, at = [], line.find(part)
    while at >= 0:
        found.append(at)
        at = line.find(part, at + 1)
    return found


class Scanner:
    """Finds phrases and notices in one text after another."""

    def __init__(self, phrases: dict[str, str], notices: dict[str, str], chars_per_edit: int):
        self.phrases = [(f" {p} ".encode(), label) for p, label in phrases.items()]
        self.notices = []
        for notice, label in notices.items():
            raw, edits = notice.encode(), len(notice) // chars_per_edit
            test = regex.compile(rb"(?<= )(?:%s){e<=%d}(?= )" % (regex.escape(raw, literal_spaces=True), edits), regex.BESTMATCH)
            self.notices.append((raw, label, edits, pieces(raw, edits), test))

    def exact(self, line: bytes) -> list[tuple[int, str]]:
        return [(at + 1, label) for phrase, label in self.phrases for at in all_places(line, phrase)]

    def fuzzy(self, line: bytes) -> list[tuple[int, int, str, int, float]]:
        """Start, end, label, edits and likeness (1 less edits over length) of every verified place, in the line."""
        found = []
        for raw, label, edits, parts, test in self.notices:
            own: list[tuple[int, int, int]] = []
            for at in sorted({at - off for off, part in parts for at in all_places(line, part)}):
                m = test.search(line, max(0, at - edits - 1), at + len(raw) + edits + 1)
                if m:
                    hit = (m.start(), m.end(), sum(m.fuzzy_counts))
                    if own and hit[0] < own[-1][1]:  # of places that overlap the one with fewer edits, the earlier among equals
                        own[-1] = min(own[-1], hit, key=lambda h: (h[2], h[0]))
                    else:
                        own.append(hit)
            found += [(a, b, label, n, 1 - n / len(raw)) for a, b, n in own]
        return sorted(set(found))


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES, chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """Per row of ``docs``: word count, exact phrases, labels, a score, and the ``spans`` of verified notices.

    A span has byte offsets in the UTF-8 text, the label, the edits and the matched words. ``score`` is 1 with an exact
    phrase, else the best likeness of a notice, else 0. Null and empty texts have no words and no labels. Repeated rows
    stay, an empty table gives an empty result, other columns are not read.
    """

    def reader():
        scanner = Scanner(phrases, notices, chars_per_edit)

        def read(texts: list[str]) -> list[pa.Array]:
            rows = []
            for text in texts:
                line, places, starts = word_line(text)
                exact, fuzzy = scanner.exact(line), scanner.fuzzy(line)
                order = np.searchsorted(starts, sorted(a for a, _ in exact))
                base = sorted({label for _, label in exact})
                both = sorted({*base, *(f[2] for f in fuzzy)})
                spans = [{"start": int(places[a]), "stop": int(places[b - 1]) + 1, "label": label, "edits": n, "found": line[a:b].decode("utf-8", "replace")} for a, b, label, n, _ in fuzzy]
                rows.append((len(starts), len(exact), int(order[0]) if exact else None, int(order[-1]) if exact else None, ",".join(base), ",".join(both), 1.0 if exact else max((f[4] for f in fuzzy), default=0.0), spans))
            columns = [list(c) for c in zip(*rows, strict=True)]
            span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("label", pa.string()), ("edits", pa.int64()), ("found", pa.string())]))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), span]
            return [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]

        return read

    return by_text(doc_texts(docs), reader, "n_words long, n_base long, first_word long, last_word long, base_labels string, "
                   "labels string, score double, spans array<struct<start long, stop long, label string, edits long, found string>>")
