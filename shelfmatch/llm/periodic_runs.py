"""Periodic runs of words by a dictionary of basic factors.

A run is a stretch with a smallest period q (words q apart are equal), long enough, that no neighbouring word prolongs. The
dictionary names every factor (stretch) of 1, 2, 4, ... words so that equal factors of a document, and only they, share a
name; two names of one length give the name of twice that length. For a length L a place whose factor next occurs d <= L
words on proposes the period d. The places that propose one period one after the other, with their successors, are the
arithmetic progressions that a periodic stretch leaves: in a run of period q with L/2 < q <= L that is q + L words long, every
factor's successor is exactly q words on, since a nearer one would make the whole run periodic by less, and a proposal
from outside would prolong the run. So a block of proposals from place a to place b extends to the run [a, b + q + L).
Runs three times as long as their period are q + L long for such L, and for short periods the first L is as large as the
shortest run allows. Every period is proposed for one L only, so no run comes twice.

All documents of a batch are named together with NumPy; a factor that recurs nowhere in its document leaves the dictionary,
so longer lengths cost next to nothing in texts that don't repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.llm.common import by_text, doc_texts

#: A run has so many words at least, and is so many times as long as its period.
LEAST, TIMES = 24, 3
RUN = "struct<start:long,length:long,period:long>"


def word_ids(texts: list[list[bytes]]) -> np.ndarray:
    """A number for each word, equal for equal words of one text only; a number of its own behind each text."""
    known: dict[bytes, int] = {}
    name = known.setdefault
    ids = np.fromiter((name(w, len(known)) for words in texts for w in [*words, b""]), np.int64)
    text_at = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    return text_at * max(len(known), 1) + ids


def recurring(places: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places whose key others share too, by key and then place, and a name 0, 1, 2, ... of each one's key."""
    order = np.argsort(keys, kind="stable")
    places, keys = places[order], keys[order]
    changed = np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.empty(0, bool)
    starts = np.flatnonzero(changed)
    often = np.repeat(np.diff(np.append(starts, len(keys))) > 1, np.diff(np.append(starts, len(keys))))
    return places[often], np.cumsum(changed[often]) - 1


def runs_of(ids: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """``start, length, period`` of all runs, by start and then period; ``ids`` as of ``word_ids``."""
    if times < 3 or least < 2:
        raise ValueError("runs shorter than three periods or two words are not found this way")
    n, found = len(ids), []
    # The largest first length that finds all short periods: q + length <= least for every q <= length / 2.
    first = 1 << ((2 * least // 3).bit_length() - 1)
    places, names = recurring(np.arange(n), ids)
    length = 1
    while len(places):
        if length >= first:
            near = np.flatnonzero(names[1:] == names[:-1])
            step = places[near + 1] - places[near]
            fits = (step <= length) & ((step > length // 2) | (length == first))
            at, period = places[near][fits], step[fits]
            order = np.lexsort((at, period))
            at, period = at[order], period[order]
            heads = np.flatnonzero(np.append(True, (period[1:] != period[:-1]) | (at[1:] != at[:-1] + 1))[:len(at)])
            tails = np.append(heads[1:], len(at))[:len(heads)] - 1
            for a, b, q in zip(at[heads].tolist(), at[tails].tolist(), period[heads].tolist(), strict=True):
                if (size := b - a + q + length) >= max(least, times * q):
                    found.append((a, size, q))
        dense = np.full(n, -1, np.int64)
        dense[places] = names
        places = np.flatnonzero(dense[: max(0, n - length)] >= 0)
        places = places[dense[places + length] >= 0]
        places, names = recurring(places, dense[places] * (n + 1) + dense[places + length])
        length *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


def runs_of_texts(texts: list[list[bytes]], least: int = LEAST, times: int = TIMES) -> Iterator[list[tuple[int, int, int]]]:
    """The runs of each text of a batch, in words from its start."""
    starts = np.cumsum([0, *(len(words) + 1 for words in texts)])
    runs = runs_of(word_ids(texts), least, times)
    owners = np.searchsorted(starts, [r[0] for r in runs], "right") - 1
    at = 0
    for i in range(len(texts)):
        first = at
        while at < len(runs) and owners[at] == i:
            at += 1
        yield [(a - int(starts[i]), size, q) for a, size, q in runs[first:at]]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by one space, without those that a run has after its first period."""
    if runs:
        stays = np.ones(len(words), bool)
        for start, size, q in runs:
            stays[start + q:start + size] = False
        words = [words[i] for i in np.flatnonzero(stays).tolist()]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``doc_id``, ``runs`` (array of ``start, length, period``, by start, then period) and the ``collapsed`` text of every row.

    Words are what ASCII white space parts; a word is a word byte for byte. Null texts count as empty: no runs, nothing
    left. A text without runs keeps all its words, one space apart. Repeated rows each get a row; an empty table gives an
    empty result; other columns are not read. Rows are read where they lie, nothing is shuffled; memory is that of a batch.
    """
    def read(texts: list[str]) -> list[pa.Array]:
        words = [t.encode("utf-8", "surrogatepass").split() for t in texts]
        runs = list(runs_of_texts(words, least, times))
        kept = [collapsed(w, r).decode("utf-8", "surrogatepass") for w, r in zip(words, runs, strict=True)]
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
        return [pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in own] for own in runs], kind), pa.array(kept)]

    return by_text(doc_texts(docs), lambda: read, f"runs array<{RUN}>, collapsed string")


def strongest(runs: Column) -> Column:
    """Of the runs the one with the greatest exact length / period; ties: the first by start, then period. Null without runs."""
    def better(best: Column, run: Column) -> Column:
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast(RUN), better)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"))


def repeated_from(words: Column, start: Column, period: Column) -> Column:
    """The words with those from ``start`` on replaced by the ``period`` words there, over and over."""
    n = F.size(words)
    times = F.ceil((n - start) / period).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, start + 1, period), times))
    return F.slice(F.concat(F.slice(words, F.lit(1), start), again), F.lit(1), n)
