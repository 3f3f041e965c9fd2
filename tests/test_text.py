import hashlib

import pytest
from pyspark.sql import functions as F

from shelfmatch.functions import parsing as ps
from shelfmatch.functions import text as tx


def check(column, function, cases):
    assert column(function, *[(given,) for given, _ in cases]) == [wanted for _, wanted in cases]


def test_addresses_lose_punctuation_and_gain_full_words(column):
    check(column, tx.norm_addr, [
        ("48 Quarry St", "48 quarry street"), ("6 E. Larch Ave", "6 east larch avenue"),
        (" 1 A  St.\t", "1 a street"), ("", ""), (None, ""), ("Hartford CT", "hartford court"),
        ("#5-B, Oak Blvd", "5b oak boulevard"), ("12 Main St Ste 4 NE", "12 main street suite 4 northeast")])


def test_names_meet_in_one_spelling(column):
    check(column, tx.norm_name, [
        ("Ales & Ciders", "ale and cider"), ("Ales and Ciders", "ale and cider"),
        ("Petra's Cellar", "petra cellar"), ("Petras Cellar", "petra cellar"), ("Barrels", "barrel"), ("Glass", "glass"),
        ("Jus", "jus"), ("Tamarind Row LLC", "tamarind row"), ("Osprey Inc.", "osprey"), ("Osprey L.L.C.", "osprey llc"),
        ("Company Store Group", "store"), ("A&B", "a and b"), (None, ""), ("O'Brien's", "obrien")])


def test_name_key_drops_generic_words_after_plurals(column):
    check(column, lambda c: tx.name_key(tx.norm_name(c)), [
        ("Liquor Store", ""), ("Tamarind Row", "tamarind row"), ("Olive's Wines & Grapes", "olive and grape"),
        ("Cannabis Place", "cannabi"), ("", "")])


def test_cannabis_words_must_stand_alone(column):
    check(column, tx.is_cannabis, [
        ("Moss Hollow Dispensary", True), ("Petra's Cellar", False), ("Dispensary, Inc", False), ("MARIJUANA hut", True),
        (None, False)])


def test_house_number_is_a_leading_number(column):
    check(column, tx.house_num, [
        ("48 quarry street", "48"), ("quarry street", None), ("12a quarry", None), ("", None), ("7", "7"), ("٣ quarry", "٣")])


def test_city_keeps_inner_text(column):
    check(column, tx.norm_city, [(" New York ", "new york"), (None, ""), ("St. Paul\t", "st. paul")])


def test_identity_fields_turn_separators_into_spaces(column):
    check(column, tx.norm_id_field, [
        ("Petra's", "petra south"), ("Rte. 9", "route 9"), ("Café½", "café½"), ("a_b", "a_b"), (None, ""),
        ("Quarry-St", "quarry street")])


def test_store_id_is_the_hash_of_normal_forms(column):
    ids = column(tx.store_id, ("Petra's", "48", "Quarry St", "Orrin", "NJ"), ("Petra's", "48", "Quarry Street", "Orrin", "NJ"),
                 ("Petra's", "49", "Quarry St", "Orrin", "NJ"), ("Ünï", None, None, "", "NJ"))
    assert ids[0] == ids[1] != ids[2]
    assert ids[0] == hashlib.md5(b"petra south|48|quarry street|orrin|nj").hexdigest()
    assert ids[3] == hashlib.md5("ünï||||nj".encode()).hexdigest()


def test_parse_bool(column):
    check(column, ps.parse_bool, [
        *[(v, True) for v in ("true", "1", "yes", "Y", " TRUE\t")], *[(v, False) for v in ("false", "0", "No", "n", "")],
        ("maybe", None), (None, False)])


def test_parse_numbers(column):
    check(column, ps.parse_float, [
        ("4.5", 4.5), (" 3 ", 3.0), ("1_000.5", 1000.5), (".5", 0.5), ("5.", 5.0), ("-1e3", -1000.0), ("1.5d", None),
        ("nan", None), ("inf", None), ("1e999", None), ("_1", None), ("1__0", None), ("", None), (None, None),
        ("0x1", None)])
    check(column, ps.parse_int, [
        ("4.9", 4), ("-4.9", -4), ("142", 142), ("1e3", 1000), ("x", None), ("1e30", None), (None, None)])


def test_parse_text_blanks_are_null(column):
    check(column, ps.parse_text, [(" a ", "a"), (" \t", None), ("", None), (None, None)])


@pytest.mark.parametrize("state, eligible", [("nj", False), ("ca", True), ("GA", True), ("", False), (None, False)])
def test_api_states(spark, state, eligible):
    assert spark.range(1).select(tx.api_eligible(F.lit(state).cast("string"))).first()[0] is eligible


ODD_SPACED = ["", " ", "a", " a b ", "\x1ca\x1d\x1eb\x1f", "\x85x\xa0", " é y　z", "​q", "!~", "\ta\nb\r", "~ \x0b", "😀 😀 ", "\x7fa "]


def test_strip_and_words_know_all_white_space(column):
    assert column(tx.strip, *[(x,) for x in ODD_SPACED]) == [x.strip() for x in ODD_SPACED]
    assert column(tx.words, *[(x,) for x in ODD_SPACED]) == [x.split() for x in ODD_SPACED]


def test_words_split_by_one_plain_character(spark):
    """Any other pattern would be compiled for every row."""
    plan = spark.range(1).select(tx.words(F.col("id").cast("string")))._jdf.queryExecution().analyzed().toString()
    assert ",  , -1)" in plan
