"""The match cascade: at most one account per store and distributor, from the first layer that has one.

Layers, in order: exact address; exact name; fuzzy name in the zip; fuzzy name in the city, or fuzzy name or address
where a city is missing, inside the state (accounts without a state count for every state, after the store's own).

The exact layers are equi joins. All fuzzy layers share one similarity join: stores become *probes* and accounts
become *entries*, rows of (block, text), where the block carries everything that has to be equal, the distributor too.
Entries with the same block and text collapse to the first account before any comparison, so copies cost nothing.
Only pairs of store and distributor that no earlier layer has settled become probes.

House numbers veto only if both are set and differ. As block values: an account with a number is listed under that
number and under ANY; one without under NONE and ANY. A store with a number looks under that number and NONE; one
without looks under ANY. The same device pairs stores and accounts of which at least one has no city.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.functions.similarity import ratio
from shelfmatch.operators import accounts as ac
from shelfmatch.operators.similarity_join import similar_texts
from shelfmatch.session import materialize

# Thresholds and layer names are part of the results.
CONFIRMED, FLAGGED = 85, 75
SAME_CITY, NO_CITY_CONFLICT = 86, 80
EXACT_ADDRESS, EXACT_NAME, FUZZY_ZIP = "exact_address", "exact_name", "fuzzy_name_zip"
FUZZY_CITY, FUZZY_NAME, FUZZY_ADDRESS = "fuzzy_name_city", "fuzzy_name", "fuzzy_address"

FUZZY_LAYERS = (FUZZY_ZIP, FUZZY_CITY, FUZZY_NAME, FUZZY_ADDRESS)

ANY, NONE = "*", "-"
HIT_COLUMNS = ("store_id", "distributor_name", "layer_rank", "match_layer", "match_confidence", "match_status",
               "rec_ord")


def _hits(df: DataFrame, rank: int, layer: str) -> DataFrame:
    return df.select(
        "store_id", "distributor_name", F.lit(rank).alias("layer_rank"), F.lit(layer).alias("match_layer"),
        F.lit(100.0).alias("match_confidence"), F.lit("confirmed").alias("match_status"), "rec_ord")


# ---- exact layers ----

def match_exact_address(candidates: DataFrame, accounts: DataFrame) -> DataFrame:
    return _hits(candidates.join(ac.last_by_key(accounts, "norm_addr"), "norm_addr"), 1, EXACT_ADDRESS)


def match_exact_name(candidates: DataFrame, accounts: DataFrame) -> DataFrame:
    """The gates apply to the last account of a name; no earlier one is tried."""
    last = ac.last_by_key(accounts, "norm_name", "state_block", "norm_city", "zip_code")
    pairs = candidates.alias("c").join(last.alias("a"), "norm_name").filter(
        (F.col("a.state_block") == "") | (F.col("a.state_block") == F.col("c.state_block")))
    pairs = pairs.filter(
        (F.col("c.norm_city") != "") | (F.col("c.zip_code") == "") | (F.col("a.zip_code") == "")
        | (F.col("c.zip_code") == F.col("a.zip_code")))
    compare = ((F.col("c.norm_city") != "") & (F.col("a.norm_city") != "")
               & (F.col("c.norm_city") != F.col("a.norm_city")))
    city_score = ratio(F.when(compare, F.col("c.norm_city")).otherwise(""),
                       F.when(compare, F.col("a.norm_city")).otherwise(""))
    return _hits(pairs.filter(city_score >= NO_CITY_CONFLICT), 2, EXACT_NAME)


# ---- fuzzy layers ----

def _block(layer: str, area: Column, place: Column, house: Column) -> Column:
    return F.struct(
        F.lit(layer).alias("layer"), area.alias("area"), place.alias("place"), house.alias("house"),
        F.col("distributor_name")).alias("block")


def _listed_under(value: Column) -> Column:
    return F.array(F.when(value.isNull(), F.lit(NONE)).otherwise(value), F.lit(ANY))


def _looks_under(value: Column) -> Column:
    return F.when(value.isNull(), F.array(F.lit(ANY))).otherwise(F.array(value, F.lit(NONE)))


def _tagged(house: Column) -> Column:
    """Keep real numbers apart from the two marks."""
    return F.concat(F.lit("#"), house)


def _similar_cities(candidates: DataFrame, accounts: DataFrame) -> DataFrame:
    """``area, store_city, account_city`` with city names close enough to be the same place."""
    def cities(df: DataFrame) -> DataFrame:
        return df.filter(F.col("norm_city") != "").select(
            F.struct("area").alias("block"), F.col("norm_city").alias("text")).distinct()

    pairs = similar_texts(
        cities(with_areas(candidates)),
        cities(accounts.withColumn("area", F.col("state_block"))), SAME_CITY)
    return pairs.select(
        F.col("block.area").alias("area"), F.col("left_text").alias("store_city"),
        F.col("right_text").alias("account_city"))


def with_areas(candidates: DataFrame) -> DataFrame:
    """A row per account state to look in: the store's own, and the blank one."""
    return candidates.withColumn("area", F.explode(F.array_distinct(F.array("state_block", F.lit(""))))).withColumn(
        "own_state", F.col("area") == F.col("state_block"))


def _with_distributors(candidates: DataFrame, accounts: DataFrame) -> DataFrame:
    """A row per candidate with an id and distributor."""
    every = accounts.agg(F.array_sort(F.collect_set("distributor_name"))).scalar()
    return candidates.filter("store_id is not null").withColumn("distributor_name", F.explode(every))


def all_pairs(candidates: DataFrame, accounts: DataFrame) -> DataFrame:
    """``store_id, distributor_name``: every store is looked for at every distributor."""
    return _with_distributors(candidates, accounts).select("store_id", "distributor_name")


def _loose_block() -> Column:
    return F.struct("layer", "area", "place", "house", "distributor_name").alias("block")


def _loose_texts() -> Column:
    return F.inline(F.array(
        F.struct(F.lit(FUZZY_NAME).alias("layer"), F.col("key_words").alias("text")),
        F.struct(F.lit(FUZZY_ADDRESS).alias("layer"), F.col("addr_words").alias("text"))))


def _probes(candidates: DataFrame, layers: Sequence[str]) -> DataFrame:
    """``store_id, has_anchor, own_state, block, text`` of candidates with an open ``distributor_name`` each."""
    houses = _looks_under(_tagged(F.col("house_num")))
    named = F.col("norm_name_key") != ""
    base = candidates.withColumn("has_anchor", (F.col("norm_city") != "") | (F.col("zip_code") != ""))
    kept = ["store_id", "has_anchor", "own_state"]
    parts = []
    if FUZZY_ZIP in layers:
        parts.append(base.filter(named & (F.col("zip_code") != "")).withColumns(
            {"own_state": F.lit(True), "house": F.explode(houses)}).select(
            *kept, _block(FUZZY_ZIP, F.col("zip_code"), F.lit(""), F.col("house")), F.col("key_words").alias("text")))
    in_state = with_areas(base.filter(~F.col("is_cannabis")))
    if FUZZY_CITY in layers:
        parts.append(in_state.filter(named & (F.col("norm_city") != "") & ~F.col("is_city_only_name")).select(
            *kept, _block(FUZZY_CITY, F.col("area"), F.col("norm_city"), F.lit("")), F.col("key_words").alias("text")))
    if FUZZY_NAME in layers or FUZZY_ADDRESS in layers:
        # With a city: only accounts without one. Without: every account.
        place = F.when(F.col("norm_city") == "", F.lit(ANY)).otherwise(F.lit(NONE))
        loose = in_state.withColumn("place", place).withColumn("house", F.explode(houses)).select(
            *kept, "area", "place", "house", "distributor_name", "norm_name_key", _loose_texts())
        parts.append(loose.filter(((F.col("layer") == FUZZY_ADDRESS) | named) & F.col("layer").isin(*layers)).select(
            *kept, _loose_block(), "text"))
    return reduce(DataFrame.unionByName, parts)


def _entries(candidates: DataFrame, accounts: DataFrame, layers: Sequence[str]) -> DataFrame:
    """``block, text, rec_ord``: the first account of the block's distributor that has the text there."""
    houses = _listed_under(_tagged(F.col("house_num")))
    named = F.col("norm_name_key") != ""
    parts = []
    if FUZZY_ZIP in layers:
        parts.append(accounts.filter(named & (F.col("zip_code") != "")).withColumn("house", F.explode(houses)).select(
            "rec_ord", _block(FUZZY_ZIP, F.col("zip_code"), F.lit(""), F.col("house")), F.col("key_words").alias("text")))
    if FUZZY_CITY in layers:
        first_in_city = (
            accounts.filter(named & (F.col("norm_city") != ""))
            .groupBy("distributor_name", "state_block", "norm_city", "key_words").agg(F.min("rec_ord").alias("rec_ord")))
        parts.append(first_in_city.alias("a").join(
            _similar_cities(candidates, accounts).alias("c"),
            (F.col("a.state_block") == F.col("c.area")) & (F.col("a.norm_city") == F.col("c.account_city"))).select(
            "rec_ord", _block(FUZZY_CITY, F.col("c.area"), F.col("c.store_city"), F.lit("")), F.col("key_words").alias("text")))
    if FUZZY_NAME in layers or FUZZY_ADDRESS in layers:
        place = _listed_under(F.when(F.col("norm_city") != "", F.lit("city")))
        loose = (
            accounts.select("distributor_name", "rec_ord", F.col("state_block").alias("area"), "norm_name_key", "house_num",
                            F.explode(place).alias("place"), "key_words", "addr_words")
            .filter(F.col("place") != "city").withColumn("house", F.explode(houses))
            .select("rec_ord", "area", "place", "house", "distributor_name", "norm_name_key", _loose_texts()))
        parts.append(loose.filter(((F.col("layer") == FUZZY_ADDRESS) | named) & F.col("layer").isin(*layers)).select(
            "rec_ord", _loose_block(), "text"))
    return reduce(DataFrame.unionByName, parts).groupBy("block", "text").agg(F.min("rec_ord").alias("rec_ord"))


def contenders(pairs: pa.Table) -> pa.Table:
    """Pairs ``left, rec_ord, score`` that are their left text's best or its first confirmed one."""
    left, score = pairs.column("left").to_numpy(), pairs.column("score").to_numpy()
    order = pc.rank(pairs.column("rec_ord"), tiebreaker="dense").to_numpy()

    def firsts(at: np.ndarray) -> np.ndarray:
        return at[np.concatenate(([True], left[at][1:] != left[at][:-1]))] if len(at) else at

    sure = np.flatnonzero(score >= CONFIRMED)
    kept = np.concatenate((firsts(np.lexsort((order, -score, left))), firsts(sure[np.lexsort((order[sure], left[sure]))])))
    return pairs.take(pa.array(np.unique(kept)))


def _picks_per_text(probe_texts: DataFrame, entries: DataFrame, first_confirmed: bool, **sizes: int) -> DataFrame:
    """For each probe text: the best account, and the first confirmed one.

    The pairs are thinned in the tasks that score them; only the picks are shuffled. ``first_confirmed``: where there is a
    confirmed one the best is of no use, so a text that has met one is not compared with accounts behind it.
    """
    until = ("rec_ord", CONFIRMED) if first_confirmed else None
    pairs = similar_texts(probe_texts, entries, FLAGGED, carry=["rec_ord"], thin=contenders, until=until, **sizes)
    return pairs.groupBy("block", F.col("left_text").alias("text")).agg(
        F.min(F.struct((-F.col("score")).alias("minus"), "rec_ord")).alias("best"),
        F.min(F.when(F.col("score") >= CONFIRMED, F.struct("rec_ord", (-F.col("score")).alias("minus"))))
        .alias("sure"))


def match_fuzzy(candidates: DataFrame, accounts: DataFrame, layers: Sequence[str] = FUZZY_LAYERS,
                open_pairs: DataFrame | None = None, **sizes: int) -> DataFrame:
    """Zip layer before state layer. In the state layer the first confirmed account wins over better later ones;
    only where none is confirmed does the best flagged one count, and not for stores without city and zip.

    ``open_pairs`` (``store_id, distributor_name``; every one if not given) are those to look for; no other is probed.
    ``sizes`` go to the similarity join.
    """
    probes = materialize(_probes(_with_distributors(candidates, accounts) if open_pairs is None else candidates.join(
        open_pairs, "store_id"), layers), "probes")
    entries = _entries(candidates, accounts, layers)
    # Picks, one a text, are written so that Spark sees how few they are: else it may copy the probes, one a store, to the few
    # tasks that the picks are in, and those would hold a row of every store. A zip code has few stores of one text, so there
    # both are dealt out by block and text, and neither is copied.
    picks = _picks_per_text(probes.select("block", "text").distinct(), entries, FUZZY_ZIP not in layers, **sizes)
    picks = picks.hint("merge") if set(layers) == {FUZZY_ZIP} else materialize(picks, "picks")
    found = probes.join(picks, ["block", "text"])

    layer = F.col("block.layer")
    in_zip = layer == FUZZY_ZIP
    foreign, by_address = ~F.col("own_state"), layer == FUZZY_ADDRESS
    sure = F.struct(foreign.alias("foreign"), F.col("sure.rec_ord"), F.col("sure.minus"),
                    by_address.alias("by_address"), layer.alias("layer"))
    best = F.struct(F.col("best.minus"), foreign.alias("foreign"), F.col("best.rec_ord"),
                    by_address.alias("by_address"), layer.alias("layer"))
    picked = found.groupBy("store_id", F.col("block.distributor_name").alias("distributor_name")).agg(
        F.min(F.when(in_zip, best)).alias("zip"),
        F.min(F.when(~in_zip & F.col("sure").isNotNull(), sure)).alias("sure"),
        F.min(F.when(~in_zip & F.col("has_anchor"), best)).alias("flagged"))

    def hit(col: str) -> Column:
        return F.struct(F.col(f"{col}.rec_ord"), (-F.col(f"{col}.minus")).alias("score"), F.col(f"{col}.layer"))

    winner = F.when(F.col("zip").isNotNull(), hit("zip")).when(F.col("sure").isNotNull(), hit("sure")).when(
        F.col("flagged").isNotNull(), hit("flagged"))
    won = picked.withColumn("winner", winner).filter(F.col("winner").isNotNull())
    return won.select(
        "store_id", "distributor_name",
        F.when(F.col("winner.layer") == FUZZY_ZIP, 3).otherwise(4).alias("layer_rank"),
        F.col("winner.layer").alias("match_layer"), F.col("winner.score").alias("match_confidence"),
        F.when(F.col("winner.score") >= CONFIRMED, "confirmed").otherwise("flagged").alias("match_status"),
        F.col("winner.rec_ord").alias("rec_ord"))


# ---- cascade ----

def first_layer(hits: DataFrame) -> DataFrame:
    """One hit per store and distributor: the earliest layer's."""
    rest = [c for c in HIT_COLUMNS if c not in ("store_id", "distributor_name")]
    first = hits.groupBy("store_id", "distributor_name").agg(F.min(F.struct(*rest)).alias("hit"))
    return first.select("store_id", "distributor_name", "hit.*")


def find_matches(stores: DataFrame, raw_accounts: DataFrame) -> DataFrame:
    """``stores`` (17 columns) with ``distributor_matches``: one entry per distributor, unmatched ones included.

    A pair of store and distributor that a layer settles is not looked at by the layers after it.
    """
    candidates = materialize(ac.matchable_candidates(stores), "candidates")
    accounts = materialize(ac.matchable_accounts(raw_accounts), "accounts")
    pair = ["store_id", "distributor_name"]

    exact = materialize(first_layer(
        match_exact_address(candidates, accounts).unionByName(match_exact_name(candidates, accounts))), "exact")
    left = all_pairs(candidates, accounts).join(exact, pair, "left_anti")
    in_zip = materialize(match_fuzzy(candidates, accounts, (FUZZY_ZIP,), left), "in-zip")
    in_state = match_fuzzy(candidates, accounts, (FUZZY_CITY, FUZZY_NAME, FUZZY_ADDRESS), left.join(in_zip, pair, "left_anti"))
    return nest_matches(stores, exact.unionByName(in_zip).unionByName(in_state), accounts)


def nest_matches(stores: DataFrame, hits: DataFrame, accounts: DataFrame) -> DataFrame:
    """The array's size is the number of distributors, in name order."""
    figures = ["case_volume", "revenue", "revenue_per_case"]
    filled = hits.join(
        accounts.select("distributor_name", "rec_ord", F.col("source_id").alias("customer_id"),
                        F.col("original_name").alias("customer_name"), *figures),
        ["distributor_name", "rec_ord"])
    entry = F.struct("distributor_name", F.lit(True).alias("matched"), "customer_id", "customer_name", "match_layer",
                     "match_confidence", "match_status", *figures)
    per_store = filled.groupBy("store_id").agg(F.map_from_entries(F.collect_list(
        F.struct("distributor_name", entry))).alias("found"))
    every = accounts.agg(F.array_sort(F.collect_set("distributor_name"))).scalar()
    nothing = F.lit(None)
    found = F.col("found")

    def unmatched(name: Column) -> Column:
        return F.struct(
            name.alias("distributor_name"), F.lit(False).alias("matched"),
            *[nothing.cast("string").alias(c) for c in ("customer_id", "customer_name", "match_layer")],
            nothing.cast("double").alias("match_confidence"), nothing.cast("string").alias("match_status"),
            *[nothing.cast("double").alias(c) for c in figures])

    def entry_for(name: Column) -> Column:
        return F.coalesce(F.try_element_at(found, name), unmatched(name))

    return (
        stores.join(per_store, "store_id", "left").withColumn("every", every)
        .withColumn("distributor_matches", F.transform("every", entry_for)).drop("found", "every")
    )


def any_match(matches: Column) -> Column:
    return F.exists(matches, lambda m: m["matched"])


def unnest_matches(universe: DataFrame) -> DataFrame:
    return universe.select("store_id", F.inline("distributor_matches"))


def account_universe(matched: DataFrame, matched_at: Column, run_date: Column) -> DataFrame:
    """The 24 published columns, in the order stores are described: identity, place, signals, matches, stamps."""
    return matched.select(
        "store_id", "brand", "store_name", "chain_name", "is_chain", "address", "house_number", "road", "parsed_city",
        "state", "zip", "parsed_country", "nj_abc_license_number", "phone", "email", "rating", "review_count",
        "distributor_matches", any_match(F.col("distributor_matches")).alias("any_distributor_match"),
        F.lit(None).cast("string").alias("place_id"), F.lit(None).cast("double").alias("lat"),
        F.lit(None).cast("double").alias("lng"), matched_at.alias("matched_at"), run_date.alias("run_date"))
