"""Pairs of close texts out of two lists, found in the metric space of their letters.

A text is the point of its letter counts. The city-block distance of two points is at most the texts' indel distance and, unlike
it, costs a product of two small matrices: letters in common are counted over a text's *features*, ``has letter l more than k
times`` for every l and k. A score of T asks for an indel distance of at most (1 - T/100) times both lengths, so:

* *Cells.* Texts of the right list gather around pivots, some of themselves, in rings; a ring knows its least and greatest
  distance from its pivot. A left text visits a ring only if, by the triangle inequality, anything in there can be near enough.
* *Points.* Of a visited ring, only pairs whose points are near enough are scored.
* *Waves.* Where only the first right text of a certain score matters, the right list comes in waves of growing size in
  that order, and left texts that have found theirs leave before the next.

Nothing that reaches the threshold is lost: every bound is one of the exact distance.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np

from shelfmatch.functions.similarity import indel_scores

#: Letters told apart (rarer ones share a number), features of a text, texts around a pivot, pivots of a wave at most.
LETTERS, FEATURES, CELL, PIVOTS = 64, 512, 32, 512
#: Width of a ring around a pivot.
RING = 2
#: Pairs scored at a time; right texts of the first wave, and how much larger each next one is.
_CHUNK, FIRST_WAVE, GROWTH = 50_000, 64, 2
#: Below this share of pairs that cells leave to visit, cells are gone through one by one.
WORTH = 0.25

Pairs = tuple[np.ndarray, np.ndarray, np.ndarray]


def letter_counts(texts: list[str], lengths: np.ndarray) -> np.ndarray:
    """A row per text: how often it has each letter. The commonest letters have a column each, the others share them."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    found, at, often = np.unique(codes, return_inverse=True, return_counts=True)
    column = np.empty(len(found), np.int64)
    column[np.argsort(-often, kind="stable")] = np.arange(len(found)) % LETTERS
    width = min(LETTERS, max(1, len(found)))
    places = np.repeat(np.arange(len(texts)), lengths) * width + (column[at] if len(found) else at)
    return np.bincount(places, minlength=len(texts) * width).reshape(len(texts), width)


def features(counts: np.ndarray, tops: np.ndarray, step: int) -> np.ndarray:
    """Whether a text has a letter more than 0, ``step``, 2 ``step``, ... times, below what both lists have of it."""
    return np.concatenate([counts[:, letter, None] > np.arange(0, top, step) for letter, top in enumerate(tops.tolist())], axis=1).astype(np.float32)


class Letters:
    """Both lists as points. With ``step`` 1 letters in common are exact, else (long texts) an upper bound."""

    def __init__(self, left: list[str], right: list[str]):
        self.lengths = np.fromiter(map(len, [*left, *right]), np.int64, len(left) + len(right))
        counts = letter_counts([*left, *right], self.lengths)
        a, b = counts[:len(left)], counts[len(left):]
        tops = np.minimum(a.max(axis=0), b.max(axis=0))
        self.step = max(1, -(-int(tops.sum()) // FEATURES))
        self.left, self.right = features(a, tops, self.step), features(b, tops, self.step)
        self.left_length, self.right_length = self.lengths[:len(left)], self.lengths[len(left):]

    def margins(self, threshold: int) -> tuple[np.ndarray, np.ndarray]:
        """Two matrices whose product is 200 x letters in common - threshold x both lengths; negative: no pair of that score.

        Whole numbers that floats of their kind hold exactly.
        """
        kind = np.float32 if 400 * int(self.lengths.max()) < 1 << 24 else np.float64
        a, b = (-threshold * n[:, None] for n in (self.left_length, self.right_length))
        left = np.concatenate([self.left * (200 * self.step), a, np.ones_like(a)], axis=1)
        return left.astype(kind), np.concatenate([self.right, np.ones_like(b), b], axis=1).astype(kind)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """City-block distances of points, at most the texts' indel distances."""
    return a.sum(axis=1)[:, None] + b.sum(axis=1)[None, :] - 2 * (a @ b.T)


def cells(space: Letters, i: np.ndarray, j: np.ndarray, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Parts of ``j``, each with those of ``i`` that can be near anything in it; one part where pivots would tell little."""
    k = min(PIVOTS, len(j) // CELL)
    if k < 2 or space.step > 1 or not len(i):
        yield i, j
        return
    pivots = space.right[j[np.linspace(0, len(j) - 1, k).astype(np.int64)]]
    own = distances(space.right[j], pivots)
    cell = own.argmin(axis=1)
    radius = own[np.arange(len(j)), cell]
    ring = cell * (1 << 20) + (radius / RING).astype(np.int64)
    order = np.argsort(ring, kind="stable")
    filled, starts = np.unique(ring[order], return_index=True)
    filled, members = filled >> 20, np.split(order, starts[1:])
    least, most = (np.array([f(radius[own]) for own in members]) for f in (np.min, np.max))
    longest = np.array([space.right_length[j[own]].max() for own in members])
    far = distances(space.left[i], pivots[filled])
    beyond = np.maximum(far - most[None, :], least[None, :] - far)
    # Indel distance is at most (1 - threshold / 100) of both lengths, those of a cell its longest text's at most.
    reached = 100 * beyond <= (100 - threshold) * (space.left_length[i][:, None] + longest[None, :])
    sizes = np.array(list(map(len, members)))
    if (reached.sum(axis=0) * sizes).sum() > WORTH * len(i) * len(j):
        yield i, j
        return
    for at, own in enumerate(members):
        yield i[reached[:, at]], j[own]


def close_pairs(left: list[str], right: list[str], threshold: int, tile: int = 1024, order: np.ndarray | None = None,
                until: float | None = None, seen: Counter | None = None) -> Iterator[Pairs]:
    """Places in ``left`` and ``right``, and scores, of all pairs that reach the threshold.

    ``until``: a left text needs no right text behind, in ``order``, its first one of this score; some may still come.
    ``seen`` counts pairs ``visited`` and ``scored``. ``tile`` bounds the matrices.
    """
    if not left or not right:
        return
    space = Letters(left, right)
    points, others = space.margins(threshold)
    j = np.arange(len(right)) if order is None else np.asarray(order)
    i, stops = np.arange(len(left)), [len(right)]
    if until is not None:
        stops, size = [min(FIRST_WAVE, len(right))], FIRST_WAVE
        while stops[-1] < len(right):
            size *= GROWTH
            stops.append(min(len(right), stops[-1] + size))
    settled = np.zeros(len(left), bool)
    start = 0
    for stop in stops:
        for near, part in cells(space, i, j[start:stop], threshold):
            for a in range(0, len(near), tile):
                for b in range(0, len(part), tile):
                    own, other = near[a:a + tile], part[b:b + tile]
                    x, y = np.nonzero(points[own] @ others[other].T >= 0)
                    if seen is not None:
                        seen.update(visited=len(own) * len(other), scored=len(x))
                    for c in range(0, len(x), _CHUNK):
                        p, q = own[x[c:c + _CHUNK]], other[y[c:c + _CHUNK]]
                        scores = indel_scores([left[n] for n in p.tolist()], [right[n] for n in q.tolist()])
                        kept = scores >= threshold
                        if until is not None:
                            settled[p[scores >= until]] = True
                        if kept.any():
                            yield p[kept], q[kept], scores[kept]
        i, start = i[~settled[i]], stop
