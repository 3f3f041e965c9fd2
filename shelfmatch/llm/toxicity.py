"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels are per document, so training tokens are labelled by association: a token of a toxic document is toxic if its word
is far more common in toxic documents than in others. On these the field learns weights for a word, its neighbours and the
step from one tag to the next. Forward-backward marginals of all tokens give the offending spans; what they sum to in a
document goes through a logistic curve fitted on the documents' own labels.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmatch.llm.common import by_text, doc_texts, held_out

WORD = re.compile(r"[^\W\d_]+")
#: Documents of each class that are learned from, about.
ROWS_PER_CLASS = 1500
#: Words the field has weights for, at most, and the documents of the sample a word must be in.
MOST_WORDS, LEAST_DOCUMENTS = 20_000, 8
#: Log-odds of being in a toxic document from which a word labels training tokens, and the different pairs of neighbours it
#: must have there, at least five and for each toxic document: copies of one document are no evidence.
LEAST_ODDS, LEAST_CONTEXTS = 2.0, 0.03
#: Tokens on each side of a labelled token that training windows hold, further windows of a document, steps of the fit, and
#: the penalty on squared weights.
AROUND, OTHER_WINDOWS, STEPS, PENALTY = 12, 4, 80, 1.0
#: Steps of a segment in the forward-backward passes.
_SEGMENT = 512


@dataclass
class Model:
    """Log-weights of being toxic: of any token, a word, the word before, the word after; of tag steps; of document sums."""

    words: dict[str, int]
    any: np.ndarray
    here: np.ndarray
    before: np.ndarray
    after: np.ndarray
    steps: np.ndarray  # from tag, to tag
    document: tuple[float, float, float]


def sample_of(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> list[tuple[str, int]]:
    """Texts and labels to learn from: a bounded share of each class, by a hash of the id.

    Shares are of the labels whose documents are there; labels of other documents don't count. A document with several labels counts as toxic if any says so. Null labels teach nothing.
    """
    marked = labels.filter("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    there = marked.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    counts = {r["toxic"]: r["count"] for r in there.groupBy("toxic").count().collect()}
    if not counts:
        return []
    scale = 1 << 40
    shares = {k: min(scale, scale * rows_per_class // n) for k, n in counts.items()}
    share = F.create_map(*[x for k, n in shares.items() for x in (F.lit(k), F.lit(n))])
    drawn = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(5)), F.lit(scale))
    chosen = marked.filter(drawn < share[F.col("toxic")])
    # Texts that no class's share reaches don't move.
    found = doc_texts(docs.filter(drawn < max(shares.values()))).join(chosen, "doc_id").select("doc_id", "text", "toxic")
    # Repeated rows must not outgrow the sample: one text of an id is enough to learn from.
    return [(r["text"], int(r["toxic"] > 0)) for r in found.groupBy("doc_id").agg(
        F.min("text").alias("text"), F.max("toxic").alias("toxic")).orderBy("doc_id").collect()]


def toxic_words(tokens: list[list[str]], labels: list[int]) -> set[str]:
    """Words whose smoothed log-odds of being in a toxic document reach the bound, in enough different places."""
    seen: dict[str, list[int]] = {}
    around: dict[str, set] = {}
    for words, label in zip(tokens, labels, strict=True):
        for word in set(words):
            seen.setdefault(word, [0, 0])[label] += 1
        for before, word, after in zip([None, *words], words, [*words[1:], None]) if label else ():
            around.setdefault(word, set()).add((before, after))
    toxic, other = sum(labels), len(labels) - sum(labels)
    return {w for w, (n, t) in seen.items() if len(around.get(w, ())) >= max(5, LEAST_CONTEXTS * toxic) and
            math.log((t + 0.5) / (toxic - t + 0.5)) - math.log((n + 0.5) / (other - n + 0.5)) >= LEAST_ODDS}


def field_scores(model: Model, ids: np.ndarray) -> np.ndarray:
    """Log-weight of being toxic of each token of a batch, from itself and its neighbours (0 is an unknown word).

    ``ids`` has a -1 between documents, which is no one's neighbour.
    """
    padded = np.concatenate(([-1], ids, [-1]))
    left, right = padded[:-2], padded[2:]
    return (np.where(ids >= 0, model.any[0] + model.here[ids], 0.0) + np.where(left >= 0, model.before[left], 0.0)
            + np.where(right >= 0, model.after[right], 0.0))


def marginals(score: np.ndarray, cut: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Probability of being toxic of every token, by forward and backward passes over all documents of a batch at once.

    ``cut`` marks places between documents, where the chain starts anew. The chain is cut into segments that all go one
    step at a time together; a segment's product of steps says how it carries tags over, so results are exact.
    """
    n = len(score)
    if not n:
        return np.empty(0)
    wide = -(-n // _SEGMENT)
    total = wide * _SEGMENT
    # Weight of going from tag a to tag b into token t: step weight times token weight; a cut forgets what was before.
    own = np.ones(total)
    own[:n] = np.exp(np.clip(score, -50, 50))
    fresh = np.ones(total, bool)
    fresh[:n] = cut
    fresh[1:n] |= cut[:n - 1]
    fresh[0] = True
    weight = np.exp(steps)
    into = np.empty((2, 2, total))
    for a in (0, 1):
        for b in (0, 1):
            into[a, b] = np.where(fresh, 1.0, weight[a, b]) * (own if b else 1.0)
    into = np.ascontiguousarray(into.reshape(2, 2, wide, _SEGMENT).transpose(3, 0, 1, 2))  # step, from, to, segment
    carry = np.zeros((2, 2, wide))
    carry[0, 0] = carry[1, 1] = 1.0
    for t in range(_SEGMENT):
        m = into[t]
        carry = np.stack([carry[:, 0] * m[0, 0] + carry[:, 1] * m[1, 0], carry[:, 0] * m[0, 1] + carry[:, 1] * m[1, 1]], axis=1)
        carry /= carry.sum(axis=(0, 1))
    first, last = np.ones((2, wide)), np.ones((2, wide))
    for s in range(1, wide):
        x = first[:, s - 1] @ carry[:, :, s - 1]
        first[:, s] = x / x.sum()
        y = carry[:, :, wide - s] @ last[:, wide - s]
        last[:, wide - s - 1] = y / y.sum()
    forward = np.empty((_SEGMENT, 2, wide))
    now = first
    for t in range(_SEGMENT):
        m = into[t]
        now = np.stack([now[0] * m[0, 0] + now[1] * m[1, 0], now[0] * m[0, 1] + now[1] * m[1, 1]])
        now /= now.sum(axis=0)
        forward[t] = now
    out = np.empty((_SEGMENT, wide))
    now = last
    for t in range(_SEGMENT - 1, -1, -1):
        both = forward[t] * now
        out[t] = both[1] / (both[0] + both[1])
        m = into[t]
        now = np.stack([m[0, 0] * now[0] + m[0, 1] * now[1], m[1, 0] * now[0] + m[1, 1] * now[1]])
        now /= now.sum(axis=0)
    return out.T.reshape(-1)[:n]


def likelihood_gradient(model: Model, ids: np.ndarray, tags: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """Observed less expected counts of all weights over padded windows (rows) of ``ids`` and ``tags``, and the windows."""
    rows, width = ids.shape
    inside = np.arange(width) < lengths[:, None]
    flat = np.where(inside, ids, -1)
    left = np.concatenate((np.full((rows, 1), -1), flat[:, :-1]), axis=1)
    right = np.concatenate((flat[:, 1:], np.full((rows, 1), -1)), axis=1)
    score = np.where(inside, model.any[0] + model.here[flat], 0) + np.where(left >= 0, model.before[left], 0) + np.where(right >= 0, model.after[right], 0)
    token = np.stack([np.ones_like(score), np.exp(np.clip(score, -50, 50))], axis=2)
    weight = np.exp(model.steps)
    forward, backward = np.empty((rows, width, 2)), np.ones((rows, width, 2))
    now = np.ones((rows, 2))
    for t in range(width):
        now = token[:, t] * (now @ weight if t else now)
        now /= now.sum(axis=1, keepdims=True)
        forward[:, t] = now
    for t in range(width - 2, -1, -1):
        now = (token[:, t + 1] * backward[:, t + 1]) @ weight.T
        now /= now.sum(axis=1, keepdims=True)
        backward[:, t] = np.where(inside[:, t + 1, None], now, 1.0)
    chance = forward * backward
    chance /= chance.sum(axis=2, keepdims=True)
    apart = np.where(inside, tags - chance[:, :, 1], 0.0)
    size = len(model.here)
    sums = [np.bincount(at[(at >= 0) & inside], apart[(at >= 0) & inside], size) for at in (flat, left, right)]
    pair = forward[:, :-1, :, None] * weight * (token[:, 1:] * backward[:, 1:])[:, :, None, :]
    pair /= pair.sum(axis=(2, 3), keepdims=True)
    seen = np.zeros_like(pair)
    r, c = np.indices(tags[:, 1:].shape)
    seen[r, c, tags[:, :-1], tags[:, 1:]] = 1.0
    return np.array([apart.sum()]), *sums, ((seen - pair) * inside[:, 1:, None, None]).sum(axis=(0, 1))


def fit_field(tokens: list[list[str]], labels: list[int], steps: int = STEPS) -> Model:
    """Weights that fit the tokens labelled by association, by gradient steps with a scale for each weight."""
    marked = toxic_words(tokens, labels)
    count: dict[str, int] = {}
    for words in tokens:
        for word in set(words):
            count[word] = count.get(word, 0) + 1
    common = sorted((w for w in count if count[w] >= LEAST_DOCUMENTS), key=lambda w: (w not in marked, -count[w], w))[:MOST_WORDS]
    known = {w: i + 1 for i, w in enumerate(common)}
    model = Model(known, np.zeros(1), *[np.zeros(len(known) + 1) for _ in range(3)], np.zeros((2, 2)), (0.0, 0.0, 0.0))
    windows: list[tuple[list[int], list[int]]] = []
    for words, label in zip(tokens, labels, strict=True):
        tags = [int(label and w in marked) for w in words]
        spots = {i for i, t in enumerate(tags) if t} | {len(words) * k // OTHER_WINDOWS for k in range(OTHER_WINDOWS) if words}
        for i in sorted(spots):
            a, b = max(0, i - AROUND), i + AROUND + 1
            windows.append(([known.get(w, 0) for w in words[a:b]], tags[a:b]))
    if not windows:
        return model
    width = 2 * AROUND + 1
    ids, tags = np.zeros((len(windows), width), np.int64), np.zeros((len(windows), width), np.int64)
    lengths = np.array([len(w) for w, _ in windows])
    for i, (w, t) in enumerate(windows):
        ids[i, :len(w)], tags[i, :len(t)] = w, t
    weights = [model.any, model.here, model.before, model.after, model.steps]
    squares = [np.full(w.shape, 1e-6) for w in weights]
    for _ in range(steps):
        for w, g, s in zip(weights, likelihood_gradient(model, ids, tags, lengths), squares, strict=True):
            g = g - PENALTY * w
            s += g * g
            w += 0.5 * g / np.sqrt(s)
    return model


def token_ids(known: dict[str, int], texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts with a -1 after each, and the words in each text."""
    ids: list[int] = []
    sizes = []
    for text in texts:
        words = WORD.findall(text.lower())
        ids += [known.get(w, 0) for w in words]
        ids.append(-1)
        sizes.append(len(words))
    return np.array(ids, np.int64), np.array(sizes, np.int64)


def token_marginals(model: Model, texts: list[str]) -> list[np.ndarray]:
    ids, sizes = token_ids(model.words, texts)
    chance = marginals(np.where(ids >= 0, field_scores(model, ids), 0.0), ids < 0, model.steps)
    stops = np.cumsum(sizes + 1)
    return [chance[b - n - 1:b - 1] for n, b in zip(sizes.tolist(), stops.tolist(), strict=True)]


def features(chance: np.ndarray) -> tuple[float, float]:
    """What a document's score is made of: the greatest marginal, and the sum of those that tag a token (as a logarithm).

    The small marginals of all other tokens stay out, or long documents would be toxic for their length.
    """
    return (math.log1p(float(chance[chance >= 0.5].sum())), float(chance.max())) if len(chance) else (0.0, 0.0)


def train(sample: list[tuple[str, int]]) -> Model | None:
    """Fit the field, then the document curve. ``None`` unless the sample has both classes."""
    labels = [label for _, label in sample]
    if len(set(labels)) < 2:
        return None
    model = fit_field([WORD.findall(text.lower()) for text, _ in sample], labels)
    rows = []
    for at in range(0, len(sample), 256):
        rows += [features(c) for c in token_marginals(model, [t for t, _ in sample[at:at + 256]])]
    x, y = np.c_[np.ones(len(rows)), np.array(rows)], np.array(labels, float)
    # Classes were sampled alike; the curve answers for that balance.
    w = np.zeros(3)
    for _ in range(50):  # Newton's steps with a small penalty
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-6, 0.1, 0.1])
        w += np.linalg.solve(h, x.T @ (y - p) - np.array([0, 0.1, 0.1]) * w)
    return Model(model.words, model.any, model.here, model.before, model.after, model.steps, tuple(w.tolist()))


def score_documents(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``score`` and the toxic ``spans`` (start, stop in characters, chance) of every whole text.

    Spans are runs of tokens that are toxic rather than not, with the greatest of their marginals. Null and empty texts
    have the score of a document without toxic tokens. Without a model every score is 0. Repeated rows stay.
    """
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("chance", pa.float64())]))

    def spans(text: str, chance: np.ndarray) -> list[dict]:
        if not len(chance) or chance.max() < 0.5:
            return []
        low = text.lower()
        places = [m.span() for m in WORD.finditer(low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text))]
        if len(places) != len(chance):  # a letter that grows in lower case: places in the lower-cased text
            places = [m.span() for m in WORD.finditer(low)]
        edges = np.flatnonzero(np.diff(np.concatenate(([False], chance >= 0.5, [False])).astype(np.int8))).reshape(-1, 2)
        return [{"start": places[a][0], "stop": places[b - 1][1], "chance": float(chance[a:b].max())} for a, b in edges.tolist()]

    def reader():
        def read(texts: list[str]) -> list[pa.Array]:
            if model is None:
                return [pa.array([0.0] * len(texts)), pa.array([[]] * len(texts), span)]
            scores, found = [], []
            for text, chance in zip(texts, token_marginals(model, texts), strict=True):
                w, (s, m) = model.document, features(chance)
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, w[0] + w[1] * s + w[2] * m)))))
                found.append(spans(text, chance))
            return [pa.array(scores, pa.float64()), pa.array(found, span)]

        return read

    return by_text(doc_texts(docs), reader, "score double, spans array<struct<start long, stop long, chance double>>")


def toxicity(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> DataFrame:
    """``doc_id, held_out, score, predicted, spans`` for every row of ``docs``.

    Learned from about ``rows_per_class`` labelled documents of each class that are not held out; only that sample comes to
    the driver. An empty table gives an empty result; labels of one class or none give scores of 0. Other columns of either
    table are not read.
    """
    learn = labels.select("doc_id", "toxic").filter(~held_out(F.col("doc_id")))
    model = train(sample_of(docs.filter(~held_out(F.col("doc_id"))), learn, rows_per_class))
    return score_documents(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")
