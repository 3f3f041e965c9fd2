"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent letter n-grams. A document's own list is compared with each by the
out-of-place distance: how many places apart an n-gram stands, the length of the profile where it does not occur.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmatch.llm.common import by_text, doc_texts, held_out, unused

ORDERS = 3
#: The score from which on a text counts as written in its nearest language. Other scripts score 0, encoded bytes and random
#: letters below 0.2; texts in a learned language, of two letters too, score more.
LEAST = 0.25
_CHUNK = 1 << 20


def letter_table() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def folded(text: str, letters: np.ndarray) -> np.ndarray:
    """Code points of the lower-cased text; a run without letters is one space, at both ends too. Empty if no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    good = letters[points]
    if not good.any():
        return np.empty(0, np.int64)
    points = np.where(good, points, 32).astype(np.int64)
    keep = good.copy()
    keep[1:] |= good[:-1]  # the first place after a word
    points = points[keep]
    if points[-1] != 32:
        points = np.append(points, 32)
    return np.concatenate(([32], points)) if points[0] != 32 else points


def grams(points: np.ndarray) -> np.ndarray:
    """Codes (21 bits a letter) of all 1- to 3-grams that hold a letter and have a space at an end only."""
    if not len(points):
        return points
    space = points == 32
    two = (points[:-1] << 21) | points[1:]
    three = (two[:-1] << 21) | points[2:]
    return np.concatenate((points[~space], two[~(space[:-1] & space[1:])], three[~space[1:-1]]))


def gram_counts(text: str, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in ascending order and their counts. Long texts are counted in pieces that overlap by two places."""
    points = folded(text, letters)
    if len(points) <= _CHUNK:
        codes = np.sort(grams(points))
        if not len(codes):
            return codes, codes
        firsts = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
        return codes[firsts], np.diff(np.concatenate((firsts, [len(codes)])))
    codes, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for at in range(0, len(points), _CHUNK):
        more, n = np.unique(grams(points[at:at + _CHUNK + 2]), return_counts=True)
        # What starts in the overlap belongs to the next piece.
        if at + _CHUNK < len(points):
            extra, m = np.unique(grams(points[at + _CHUNK:at + _CHUNK + 2]), return_counts=True)
            n[np.searchsorted(more, extra)] -= m
        codes, into = np.unique(np.concatenate((codes, more)), return_inverse=True)
        counts = np.bincount(into, np.concatenate((counts, n)), len(codes)).astype(np.int64)
    return codes[counts > 0], counts[counts > 0]


def ranked(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent codes, most frequent first; the smaller code first among equals."""
    if len(codes) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        keep = counts >= least
        codes, counts = codes[keep], counts[keep]
    return codes[np.argsort(-counts, kind="stable")][:size]


def learn_profiles(docs: DataFrame, size: int = 400, rows_per_language: int = 1500) -> dict[str, list[int]]:
    """The profile of each non-null ``lang``, learned from ``text`` and ``lang`` of ``docs``.

    A bounded sample is enough: different texts are taken by a hash so that about ``rows_per_language`` of each language
    remain; copies count once, so that no text makes a profile alone. Counts are made per task, summed by Spark, and only
    the profiles come to the driver.
    """
    known = docs.select("lang", "text").filter("lang is not null and text is not null")
    own = F.xxhash64("text", F.lit(11))
    counts = {r["lang"]: max(1, r["n"]) for r in known.groupBy("lang").agg(F.approx_count_distinct(own, 0.02).alias("n")).collect()}
    if not counts:
        return {}
    scale = 1 << 40
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(scale, scale * rows_per_language // n)))])
    sample = known.filter(F.pmod(own, F.lit(scale)) < share[F.col("lang")]).distinct()

    def count(batches):
        letters, sums = letter_table(), {}

        def flush():
            for lang, (codes, n) in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n)], ["lang", "code", "n"])
            sums.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                codes, n = gram_counts(text, letters)
                if lang in sums:
                    codes, into = np.unique(np.concatenate((sums[lang][0], codes)), return_inverse=True)
                    n = np.bincount(into, np.concatenate((sums[lang][1], n)), len(codes)).astype(np.int64)
                sums[lang] = codes, n
            if sum(len(c) for c, _ in sums.values()) > _CHUNK:
                yield from flush()
        yield from flush()

    counted = sample.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    profiles: dict[str, list[int]] = {lang: [] for lang in counts}
    for row in sorted(counted.withColumn("place", place).filter(F.col("place") <= size).select("lang", "place", "code").collect()):
        profiles[row["lang"]].append(row["code"])
    return profiles


class Profiles:
    """Distances of a document's n-grams to all profiles at once."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.names, self.size, self.letters = sorted(p for p in profiles if profiles[p]), size, letter_table()
        self.codes = np.unique(np.concatenate([np.empty(0, np.int64), *[np.array(profiles[n], np.int64) for n in self.names]]))
        self.places = np.full((len(self.names), len(self.codes) + 1), -1, np.int64)
        for i, name in enumerate(self.names):
            self.places[i, np.searchsorted(self.codes, profiles[name])] = np.arange(len(profiles[name]))

    def best(self, text: str) -> tuple[str, float]:
        """The nearest language (the first name among equals) and how near: 1 the same list, 0 nothing in common."""
        if not self.names:
            return "und", 0.0
        mine = ranked(*gram_counts(text, self.letters), self.size)
        if not len(mine):
            return "und", 0.0
        at = np.searchsorted(self.codes, mine)
        at[at == len(self.codes)] = 0
        at = np.where(self.codes[at] == mine, at, len(self.codes))
        places = self.places[:, at]
        apart = np.where(places < 0, self.size, np.minimum(np.abs(places - np.arange(len(mine))), self.size)).sum(axis=1)
        i = int(apart.argmin())
        return self.names[i], 1.0 - float(apart[i]) / (self.size * len(mine))


def identify(docs: DataFrame, profiles: dict[str, list[int]], size: int = 400, keep: tuple[str, ...] = ("doc_id",),
             names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``keep``, predicted language and score (0 to 1, both called by ``names``) for every row, from its whole text.

    Null and empty texts, and texts without a letter, are ``und`` with score 0, as are all texts if there are no profiles.
    """

    def reader():
        model = Profiles(profiles, size)

        def read(texts: list[str]) -> list[pa.Array]:
            found, scores = zip(*[model.best(t) for t in texts], strict=True)
            return [pa.array(found, pa.string()), pa.array(scores, pa.float64())]

        return read

    return by_text(docs, reader, f"{names[0]} string, {names[1]} double", keep)


def language_ids(docs: DataFrame, size: int = 400, rows_per_language: int = 1500) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: learned from rows that are not held out, applied to all.

    Repeated rows stay, rows without a ``lang`` teach nothing, an empty table gives an empty result, other columns are not
    read. ``doc_id`` only says which rows are held out.
    """
    profiles = learn_profiles(docs.filter(~held_out(F.col("doc_id"))), size, rows_per_language)
    return identify(doc_texts(docs), profiles, size).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def known_language(docs: DataFrame, size: int = 400, rows_per_language: int = 1500, least: float = LEAST,
                   languages: tuple[str, ...] | None = None) -> DataFrame:
    """The rows of ``docs`` whose predicted language is one of ``languages`` (all that are learned unless told), with all columns.

    Rejected are null and empty texts and those without a letter, and texts that no profile comes as near to as ``least``.
    If no row names a language there are no profiles, and only texts without a letter are rejected.
    """
    profiles = learn_profiles(docs.filter(~held_out(F.col("doc_id"))), size, rows_per_language)
    if not any(profiles.values()):
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    lang, score = unused("lang_pred", docs.columns), unused("score", docs.columns)
    found = identify(docs, profiles, size, tuple(docs.columns), (lang, score))
    wanted = F.col(lang) != "und" if languages is None else F.col(lang).isin(*languages)
    return found.filter(wanted & (F.col(score) >= least)).drop(lang, score)
