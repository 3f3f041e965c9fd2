import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfmatch.functions import letter_space
from shelfmatch.functions.letter_space import Letters, close_pairs, distances
from shelfmatch.functions.similarity import indel_scores, lcs_lengths
from shelfmatch.operators import similarity_join
from shelfmatch.operators.similarity_join import similar_texts, with_units


def lcs_table(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        left = 0
        new = [0]
        for j, y in enumerate(b, 1):
            left = row[j - 1] + 1 if x == y else max(row[j], left)
            new.append(left)
        row = new
    return row[-1]


def score(a: str, b: str) -> float:
    return 100.0 if not a and not b else 200.0 * lcs_table(a, b) / (len(a) + len(b))


texts = st.text(alphabet="abc é😀\x00", max_size=90)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(texts, texts), min_size=1, max_size=8))
def test_batch_scores_equal_the_table(pairs):
    a, b = [x for x, _ in pairs], [y for _, y in pairs]
    assert lcs_lengths(a, b).tolist() == [lcs_table(x, y) for x, y in pairs]
    assert indel_scores(a, b).tolist() == [score(x, y) for x, y in pairs]


def test_known_scores():
    assert indel_scores(["liberty", "", "a", "clinton"], ["libertee", "", "", "clifton"]).round(6).tolist() == [
        80.0, 100.0, 0.0, 85.714286]


def test_lengths_around_the_word_size():
    rng = random.Random(5)
    sizes = (1, 63, 64, 65, 128, 255, 256, 257, 400)
    pairs = [("".join(rng.choices("abcd", k=n)), "".join(rng.choices("abcd", k=m))) for n in sizes for m in sizes]
    assert lcs_lengths(*map(list, zip(*pairs))).tolist() == [lcs_table(a, b) for a, b in pairs]


def near_copies(rng: random.Random, seeds: list[str], n: int, alphabet: str) -> set[tuple[str, str]]:
    rows = set()
    for _ in range(n):
        chars = list(rng.choice(seeds))
        for _ in range(rng.randint(0, 5)):
            place = rng.randint(0, len(chars))
            if rng.random() < 0.5:
                chars[place:place + 1] = []
            else:
                chars.insert(place, rng.choice(alphabet))
        rows.add((rng.choice("xyz"), "".join(chars)))
    return rows


@pytest.mark.parametrize("threshold", [75, 85, 86, 100])
@pytest.mark.parametrize("unit, tile, pairs", [(8, 8, 1), (30, 1024, 16_384), (40, 7, 100), (10**9, 5, 1)])
def test_join_equals_comparing_every_pair(spark, monkeypatch, threshold, unit, tile, pairs):
    monkeypatch.setattr(similarity_join, "SMALL", pairs)
    monkeypatch.setattr(similarity_join, "ROWS", 50)
    rng = random.Random(threshold)
    seeds = ["", "a", "ab", "aaaaaaaa", "blue anvil", "old red widget", "10 main street city 4 nj", "zq^$ 7é😀"]
    left, right = (sorted(near_copies(rng, seeds, 150, "ab e1é")) for _ in range(2))
    wanted = {(g, a, b) for g, a in left for h, b in right if g == h and score(a, b) >= threshold}
    frames = [spark.createDataFrame(rows, "block string, text string") for rows in (left, right)]
    found = [tuple(r) for r in similar_texts(*frames, threshold, unit, tile).drop("score").collect()]
    assert len(found) == len(set(found))
    assert set(found) == wanted and wanted


def similar_pairs(a, b, threshold, **more):
    found = list(close_pairs(a, b, threshold, **more))
    return [np.concatenate([part[k] for part in found]) if found else np.empty(0) for k in range(3)]


@settings(max_examples=100, deadline=None)
@given(st.lists(texts, max_size=8), st.lists(texts, max_size=8), st.integers(0, 100))
def test_pairs_of_a_tile(a, b, threshold):
    i, j, scores = similar_pairs(a, b, threshold)
    wanted = {(x, y): score(s, t) for x, s in enumerate(a) for y, t in enumerate(b) if score(s, t) >= threshold}
    assert dict(zip(zip(i.tolist(), j.tolist()), scores.tolist())) == wanted


def test_pairs_of_very_long_texts():
    long = ["ab" * 3000, "ab" * 2900 + "c" * 100, "c" * 6000, "a" * 2500]
    i, j, _ = similar_pairs(long, long, 90)
    assert set(zip(i.tolist(), j.tolist())) == {(x, x) for x in range(4)} | {(0, 1), (1, 0)}


def test_carried_columns_stay_with_their_text(spark):
    from pyspark.sql import functions as F

    names = [f"golden cellar {i:03}" for i in range(80)]
    left = spark.createDataFrame([("x", n) for n in names], "block string, text string")
    right = spark.createDataFrame(left.collect(), left.schema).withColumn("firsts", F.array(F.struct(F.upper("text").alias("d"), F.length("text").alias("n"))))
    for unit in (16, 10**9):
        out = similar_texts(left, right, 100, unit, 32, carry=["firsts"]).collect()
        assert sorted((r["left_text"], r["firsts"][0]["d"], r["firsts"][0]["n"]) for r in out) == [
            (n, n.upper(), 17) for n in names]


def test_copies_of_a_wide_block_stay_few(spark):
    """Texts of one block, 3,000 a side with lengths from 1 to 300: a text is copied to the cuts of near bands only."""
    from pyspark.sql import functions as F

    def side(seed):
        return spark.range(3000).select(F.lit("x").alias("block"), F.expr(f"substring(repeat(sha2(cast(id + {seed} as string), 256), 5), 1, cast(id % 300 + 1 as int))").alias("text"))

    rows = with_units(side(0), side(9000), 75, 500, [])
    texts = side(0).withColumn("band", similarity_join.length_band(F.length("text"), 75)).groupBy("band").count().collect()
    size = {r["band"]: r["count"] for r in texts}
    bound = sum(n * -(-size[b] // 500) for k, n in size.items() for b in size if abs(b - k) <= 1)
    assert rows.count() == 2 * bound < 6000 * 6  # 6: each text to every cut of the other side, whatever its length
    assert rows.groupBy("u1", "u2", "side").count().agg(F.max("count")).first()[0] < 1000


def test_bands_part_no_similar_lengths(spark):
    from pyspark.sql import functions as F

    for threshold in (1, 50, 75, 86, 100):
        band = {r["n"]: r["b"] for r in spark.range(1, 401).select(
            F.col("id").alias("n"), similarity_join.length_band(F.col("id"), threshold).alias("b")).collect()}
        for a in range(1, 401):
            for b in range(a, 401):
                if 200 * a >= threshold * (a + b):
                    assert abs(band[a] - band[b]) <= 1


def names(rng: random.Random, n: int) -> list[str]:
    """Names of two words out of a few hundred, with typing errors in a third."""
    words = ["".join(rng.choice("bcdfghklmnprstvw") + rng.choice("aeiou") for _ in range(rng.randint(2, 3))) for _ in range(400)]
    found = set()
    while len(found) < n:
        name = list(" ".join(sorted(rng.sample(words, 2))))
        for _ in range(rng.choice((0, 0, 1, 2))):
            name[rng.randrange(len(name))] = rng.choice("xyz")
        found.add("".join(name))
    return sorted(found)


@pytest.mark.parametrize("threshold", [75, 86, 95])
def test_cells_lose_no_pair(threshold, monkeypatch):
    rng = random.Random(threshold)
    left, right = names(rng, 300), names(rng, 900)
    right[::3] = [x + rng.choice(["", "s", " co"]) for x in left]
    i, j = np.divmod(np.arange(len(left) * len(right)), len(right))
    scores = indel_scores([left[x] for x in i], [right[x] for x in j])
    wanted = {(x, y) for x, y, s in zip(i.tolist(), j.tolist(), scores.tolist()) if s >= threshold}
    for worth in (0.0, 0.5, 1.0):  # dense, as it comes, cell by cell
        monkeypatch.setattr(letter_space, "WORTH", worth)
        a, b, s = similar_pairs(left, right, threshold, tile=100)
        assert len(a) == len(wanted) and set(zip(a.tolist(), b.tolist())) == wanted
        assert all(scores[x * len(right) + y] == z for x, y, z in zip(a.tolist(), b.tolist(), s.tolist()))


def test_letters_bound_the_distance():
    rng = random.Random(2)
    a, b = names(rng, 40), names(rng, 40)
    space = Letters(a, b)
    near = distances(space.left, space.right)
    points, others = space.margins(75)
    spare = points @ others.T
    for x, s in enumerate(a):
        for y, t in enumerate(b):
            assert near[x, y] <= len(s) + len(t) - 2 * lcs_table(s, t)
            assert spare[x, y] >= 200 * lcs_table(s, t) - 75 * (len(s) + len(t))


def test_few_pairs_are_scored_and_cells_spare_visits():
    """Of 1,500 x 6,000 names under five in a hundred are scored, and of close ones not all are even visited."""
    rng = random.Random(9)
    left, right = names(rng, 1500), names(rng, 6000)
    for threshold, visits in ((75, 1.0), (85, 0.2)):
        seen = Counter()
        for _ in close_pairs(left, right, threshold, seen=seen):
            pass
        assert seen["scored"] < 0.05 * len(left) * len(right)
        assert seen["visited"] <= visits * len(left) * len(right)


def test_waves_keep_the_first_confirmed_and_spare_the_rest():
    rng = random.Random(10)
    left, right = names(rng, 500), names(rng, 4000)
    right = [*left, *right]
    order = np.array(rng.sample(range(len(right)), len(right)))
    rank = np.argsort(order)

    def firsts(**more):
        best = {}
        for i, j, s in close_pairs(left, right, 75, order=order, **more):
            for x, y, z in zip(i.tolist(), j.tolist(), s.tolist()):
                if z >= 85:
                    best[x] = min(best.get(x, (10**9, 0, 0)), (int(rank[y]), y, z))
        return best

    whole, waves = Counter(), Counter()
    assert firsts(until=85, seen=waves) == firsts(seen=whole) and len(firsts()) >= 500
    assert waves["scored"] < 0.8 * whole["scored"] and waves["visited"] < 0.8 * whole["visited"]
