"""URL rules by Bloom filter cascades, in column functions only.

A rule is a host and a path prefix; its key is both put together. A url's candidate keys are its host's suffixes with the
prefixes of its path, in the lengths that rules have. Level 0 of a cascade holds the listed keys; level 1 the keys of the
corpus that level 0 wrongly passes; level 2 the listed keys that level 1 wrongly passes, and so on until a level passes
nothing wrongly. A key of the corpus is listed if the first level that rejects it is an odd one: exact, without a join.

The filters travel in the plan, as the list does that a caller hands over: at about 1.5 bits a key for each halving of the wrong
keys they are shorter than the list itself.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Level:
    """A Bloom filter: its words of 64 bits and the number of hashes."""

    words: tuple[int, ...]
    hashes: int


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``, A-Z lower-cased) and path (up to ``?`` or ``#``); both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def candidate_keys(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """Keys that a url could be listed by: host suffixes of so many labels, path prefixes of so many characters."""
    parts = F.split(host, r"\.", -1)
    hosts = [F.when(F.size(parts) >= n, F.concat_ws(".", F.slice(parts, -n, n))) for n in labels]
    paths = [F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]
    return F.array_compact(F.array_distinct(F.array(*[F.concat(h, p) for h in hosts for p in paths])))


def bit_places(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(bits)) for i in range(hashes)]


def build_level(keys: DataFrame, count: int, level: int, rate: float) -> Level:
    """A Bloom filter of ``count`` keys; set bits are merged per word by Spark, the words are the filter itself."""
    bits = 64 * max(1, math.ceil(-count * math.log(rate) / math.log(2) ** 2 / 64))
    hashes = max(1, round(bits / count * math.log(2))) if count else 1
    hashes = min(hashes, max(1, round(-math.log2(rate))))
    places = keys.select(F.explode(F.array(*bit_places(F.col("key"), level, bits, hashes))).alias("at"))
    found = places.groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits")).collect()
    words = [0] * (bits // 64)
    for row in found:
        words[row["word"]] = row["bits"]
    return Level(tuple(words), hashes)


def passes(key: Column, level: Level, number: int) -> Column:
    """Whether a key passes a level. The words are a literal that the optimizer folds.

    The first test, which rejects half of all keys, stands alone; the others share one literal.
    """
    words = F.split(F.lit(" ".join(map(str, level.words))), " ").cast("array<bigint>")

    def met(at: Column) -> Column:
        return F.getbit(F.get(words, F.shiftright(at, 6).cast("int")), (at % 64).cast("int")) == 1

    first, *rest = bit_places(key, number, 64 * len(level.words), level.hashes)
    return met(first) & F.forall(F.array(*rest), met) if rest else met(first)


def listed(key: Column, cascade: list[Level]) -> Column:
    """Whether a key of the corpus is in the cascade's list."""
    found: Column = F.lit(len(cascade) % 2 == 1)
    for number in reversed(range(len(cascade))):
        found = F.when(~passes(key, cascade[number], number), F.lit(number % 2 == 1)).otherwise(found)
    return found


def listed_of(keys: str, cascade: list[Level]) -> Column:
    """Those of an array of keys that are in the cascade's list."""
    return F.filter(keys, lambda key: listed(key, cascade))


def build_cascade(universe: DataFrame, keys: DataFrame) -> list[Level]:
    """Levels that tell the rows of ``keys`` from all other rows of ``universe`` (both a string column ``key``).

    The universe needn't be distinct and is never shuffled: only what level 0 passes is.
    """
    inside = materialize(keys.select("key").distinct(), "listed-keys")
    count = inside.count()
    if not count:
        return []
    others = universe.select(F.approx_count_distinct("key")).first()[0]
    # The first level should pass about as many wrong keys as there are right ones; later ones pass half.
    rate = min(0.5, max(2.0 ** -20, math.sqrt(0.5) * count / max(others, 1)))
    cascade, held, n = [], inside, count
    outside = None
    while n:
        number = len(cascade)
        cascade.append(build_level(held, n, number, rate))
        if outside is None:
            passed = universe.select("key").filter(passes(F.col("key"), cascade[0], 0)).distinct()
            outside = materialize(passed.join(inside, "key", "left_anti"), "wrongly-passed")
            held, other = outside, inside
        else:
            held, other = materialize(other.filter(passes(F.col("key"), cascade[-1], number)), "wrongly-passed"), held
        n, rate = held.count(), 0.5
    return cascade


def url_verdicts(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages`` (``page_id``, ``url``).

    ``rules`` are pairs of verdict and host with path prefix. The longest fitting rule decides (among equals the one with
    the longer host); a rule in both lists blocks. A url that no rule fits, a null url and one without ``://`` are allowed,
    with a null ``rule``; the last two have empty parts. Repeated rows stay. Other columns are not read.
    """
    if not rules:
        host, path = url_parts(F.col("url"))
        return pages.select("page_id", host.alias("host"), path.alias("path"), F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    spark = pages.sparkSession
    # Rules by the shape of their keys; the list itself is a table.
    shapes = [(r.partition("/")[0], "/" + r.partition("/")[2] if "/" in r else "") for _, r in rules]
    labels, lengths = sorted({h.count(".") + 1 for h, _ in shapes}, reverse=True), sorted({len(p) for _, p in shapes}, reverse=True)
    listing = json.dumps([{"verdict": v, "key": r} for v, r in rules])
    table = spark.range(1).select(F.inline(F.from_json(F.lit(listing), "array<struct<verdict string, key string>>")))
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    keyed = parts.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), labels, lengths))
    universe = keyed.select(F.explode("keys").alias("key"))
    hits = {v: listed_of("keys", build_cascade(universe, table.filter(F.col("verdict") == v))) for v in ("block", "allow")}
    split = keyed.withColumns({"blocked": hits["block"], "allowed": hits["allow"]})
    # array_sort is ascending: the longest key last, a longer host after a shorter one.
    ordered = F.array_sort(F.transform(F.concat("blocked", "allowed"), lambda key: F.struct(
        F.length(key).alias("n"), F.length(F.substring_index(key, "/", 1)).alias("h"), key.alias("key"))))
    rule = F.element_at(ordered, -1)["key"]
    return split.withColumn("rule", F.when(F.size(ordered) > 0, rule)).select(
        "page_id", "host", "path", "rule",
        F.when(F.array_contains("blocked", F.col("rule")), "block").otherwise("allow").alias("verdict"))
