"""Indel similarity of two texts, 0 to 100: 200 * LCS / (len a + len b); two empty texts score 100."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WORD = 64
_CELLS = 1 << 22  # characters of a batch, both sides
_ALL_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)
_MOST = 2_000  # letters counted per text, so that sums over an alphabet of 32 still fit
_CHUNK = 50_000  # pairs scored at a time
_LEFT_PAD, _RIGHT_PAD = 0xFFFFFFFF, 0xFFFFFFFE  # no code point, and unequal, so padding never matches


def _code_points(texts: list[str], lengths: np.ndarray, pad: int) -> np.ndarray:
    width = int(lengths.max())
    grid = np.array(texts, dtype=f"<U{width}").view(np.uint32).reshape(len(texts), width).copy()
    grid[np.arange(width)[None, :] >= lengths[:, None]] = pad
    return grid


def _lcs_batch(pattern: list[str], text: list[str]) -> np.ndarray:
    """Bit-parallel LCS over a whole batch (Hyyro 2004): a row of machine words per pattern, with carries between them."""
    pattern_len = np.fromiter(map(len, pattern), np.int64, len(pattern))
    text_len = np.fromiter(map(len, text), np.int64, len(text))
    rows = _code_points(pattern, pattern_len, _LEFT_PAD)
    columns = _code_points(text, text_len, _RIGHT_PAD)
    words = -(-rows.shape[1] // _WORD)
    state = np.full((words, len(pattern)), _ALL_ONES)
    packed = np.zeros((len(pattern), 8 * words), dtype=np.uint8)
    for position in range(columns.shape[1]):
        bits = np.packbits(rows == columns[:, position, None], axis=1, bitorder="little")
        packed[:, :bits.shape[1]] = bits
        matches = packed.view(np.uint64)
        carry = np.zeros(len(pattern), np.uint64)
        for word in range(words):
            hits = state[word] & matches[:, word]
            total = state[word] + hits
            over = total < hits
            total += carry
            carry = (over | (total < carry)).astype(np.uint64)
            state[word] = total | (state[word] - hits)
    return words * _WORD - np.bitwise_count(state).sum(axis=0, dtype=np.int64)


def lcs_lengths(a: list[str], b: list[str]) -> np.ndarray:
    """Pairs are compared in batches of like lengths, so one long text widens no other's arrays."""
    pairs = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(a, b)]
    result = np.zeros(len(pairs), dtype=np.int64)
    alike: dict[tuple[int, int], list[int]] = {}
    for i, (x, y) in enumerate(pairs):
        if x:
            alike.setdefault((-(-len(x) // _WORD), len(y).bit_length()), []).append(i)
    for (words, bits), own in alike.items():
        size = max(1, _CELLS // (_WORD * words + (1 << bits)))
        for start in range(0, len(own), size):
            part = own[start:start + size]
            result[part] = _lcs_batch([pairs[i][0] for i in part], [pairs[i][1] for i in part])
    return result


def indel_scores(a: list[str], b: list[str]) -> np.ndarray:
    total = np.fromiter(map(len, a), np.int64, len(a)) + np.fromiter(map(len, b), np.int64, len(b))
    scores = 200.0 * lcs_lengths(a, b) / np.maximum(total, 1)
    return np.where(total == 0, 100.0, scores)


def _letter_counts(texts: list[str], letters: dict[str, int]) -> np.ndarray:
    """One row per letter, one column per text; rows of ``uint16`` keep the comparison below cheap."""
    counts = np.zeros((len(letters), len(texts)), dtype=np.uint16)
    for column, text in enumerate(texts):
        for letter, n in Counter(text).items():
            if letter in letters:
                counts[letters[letter], column] = min(n, _MOST)
    return counts


def scored_pairs(texts: list[str], i: np.ndarray, j: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the pairs at places ``i, j`` those that reach the threshold, and their scores.

    Letters two texts have in common, counted with repeats, are at least their LCS: most pairs fail on that alone.
    """
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    fits = np.minimum(lengths[i], lengths[j]) * 200 >= threshold * (lengths[i] + lengths[j])
    i, j = i[fits], j[fits]
    own = sorted({letter for place in np.unique(np.concatenate((i, j))).tolist() for letter in texts[place]})
    counts = _letter_counts(texts, {letter: row for row, letter in enumerate(own)})
    scores = []
    for start in range(0, len(i), _CHUNK):
        a, b = i[start:start + _CHUNK], j[start:start + _CHUNK]
        common = np.zeros(len(a), np.int64)
        for row in counts:
            common += np.minimum(row[a], row[b])
        enough = common * 200 >= threshold * (lengths[a] + lengths[b])
        enough |= (lengths[a] > _MOST) & (lengths[b] > _MOST)
        score = np.full(len(a), -1.0)
        at = np.flatnonzero(enough)
        if len(at):
            score[at] = indel_scores([texts[x] for x in a[at]], [texts[x] for x in b[at]])
        scores.append(score)
    score = np.concatenate(scores) if scores else np.empty(0)
    kept = score >= threshold
    return i[kept], j[kept], score[kept]


@F.pandas_udf(T.DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(indel_scores(a.tolist(), b.tolist()))


# Otherwise a filter on a score is pushed below the column that holds it, and every pair is scored twice.
_ratio = _ratio.asNondeterministic()


def ratio(a: Column, b: Column) -> Column:
    """Both texts must be non-null."""
    return _ratio(a, b)
