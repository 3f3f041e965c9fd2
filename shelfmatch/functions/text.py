"""Column helpers that normalise names, addresses and identity fields.

Patterns run with Java's ``(?U)`` flag where letters, digits, spaces and word boundaries must follow Unicode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every word list, abbreviation map and pattern below decides which stores match.
ADDRESS_ABBREVIATIONS = {
    "st": "street", "ave": "avenue", "blvd": "boulevard", "dr": "drive",
    "rd": "road", "ln": "lane", "ct": "court", "pl": "place",
    "hwy": "highway", "pkwy": "parkway",
    "n": "north", "s": "south", "e": "east", "w": "west",
    "ne": "northeast", "nw": "northwest", "se": "southeast", "sw": "southwest",
    "ste": "suite", "apt": "apartment",
}
IDENTITY_ABBREVIATIONS = {
    "st": "street", "ave": "avenue", "blvd": "boulevard", "dr": "drive",
    "rd": "road", "ln": "lane", "ct": "court", "pl": "place",
    "hwy": "highway", "pkwy": "parkway", "rt": "route", "rte": "route",
    "ste": "suite", "apt": "apartment",
    "n": "north", "s": "south", "e": "east", "w": "west",
}
GENERIC_NAME_WORDS = (
    "smoke", "shop", "shops", "wellness", "dispensary", "cannabis", "cbd", "hemp",
    "liquor", "liquors", "wine", "wines", "beer", "beers", "spirits", "beverage",
    "store", "stores", "mart", "market", "markets", "pharmacy", "drug",
    "health", "natural", "naturals", "supply", "depot", "center", "centres",
    "centre", "place", "station", "lounge", "cafe", "bar", "grill",
    "restaurant", "boutique", "gallery", "deli", "grocery", "food",
    "tobacco", "vape", "vapor", "convenience", "discount", "outlet", "express",
)
CANNABIS_WORDS = ("dispensary", "dispensaries", "cannabis", "marijuana")
COMPANY_WORDS = r"\s*\b(llc|l\.l\.c\.|inc\.?|corp\.?|ltd\.?|co\.?|company|group|holdings|incorporated)\b"
AMPERSAND = r"\s*&\s*"
POSSESSIVE = r"'s\b"
IDENTITY_SEPARATORS = r"[^\p{L}\p{N}_\s]"
API_STATES = ("CA", "TX", "FL", "NY", "IL", "WA", "PA", "OH", "GA", "NC")

SPACE = r"[\s\x1c-\x1f]"
DIGITS_ONLY = r"^([\p{Nd}²³¹⁰⁴-⁹₀-₉]+)(?: |$)"


def blank_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def strip(col: Column) -> Column:
    """Trim all Unicode white space; the built-in ``trim`` removes plain spaces only.

    Most texts begin and end with a printable ASCII character, which is cheaper to see than to search.
    """
    plain = F.substring(col, 1, 1).between("!", "~") & F.substring(col, -1, 1).between("!", "~")
    return F.when(plain, col).otherwise(F.regexp_replace(col, f"(?U)^{SPACE}+|{SPACE}+$", ""))


def null_if_blank(col: Column) -> Column:
    return F.nullif(strip(col), F.lit(""))


def words(col: Column) -> Column:
    # Spark compiles a pattern once to replace by it, but for every row to split by it, unless it is one plain character.
    return F.filter(F.split(F.regexp_replace(col, f"(?U){SPACE}+", " "), " "), lambda word: word != "")


def _without_punctuation(col: Column) -> Column:
    return F.regexp_replace(col, r"\p{Punct}", "")


def _expand(tokens: Column, abbreviations: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in abbreviations.items() for x in pair])
    return F.transform(tokens, lambda word: F.coalesce(F.try_element_at(table, word), word))


def norm_addr(text: Column) -> Column:
    tokens = words(_without_punctuation(F.lower(blank_if_null(text))))
    return F.array_join(_expand(tokens, ADDRESS_ABBREVIATIONS), " ")


def norm_name(text: Column) -> Column:
    text = F.regexp_replace(blank_if_null(text), "(?iU)" + COMPANY_WORDS, "")
    text = F.regexp_replace(text, "(?U)" + AMPERSAND, " and ")
    text = F.regexp_replace(text, "(?iU)" + POSSESSIVE, "s")
    singular = F.transform(
        words(_without_punctuation(F.lower(text))), lambda word: F.regexp_replace(word, "^(.{2,}[^s])s$", "$1"))
    return F.array_join(singular, " ")


def name_key(normalised_name: Column) -> Column:
    kept = F.filter(F.split(normalised_name, " "), lambda word: ~word.isin(*GENERIC_NAME_WORDS))
    return F.array_join(kept, " ")


def is_cannabis(name: Column) -> Column:
    return F.arrays_overlap(
        words(F.lower(blank_if_null(name))), F.array(*[F.lit(word) for word in CANNABIS_WORDS]))


def norm_city(text: Column) -> Column:
    return strip(F.lower(blank_if_null(text)))


def house_num(normalised_addr: Column) -> Column:
    return F.nullif(F.regexp_extract(normalised_addr, DIGITS_ONLY, 1), F.lit(""))


def sorted_words(text: Column) -> Column:
    """Token-sorted form; two texts compare order-free once both are in it."""
    return F.array_join(F.array_sort(words(text)), " ")


def norm_id_field(text: Column) -> Column:
    spaced = F.regexp_replace(F.lower(blank_if_null(text)), "(?U)" + IDENTITY_SEPARATORS, " ")
    return F.array_join(_expand(words(spaced), IDENTITY_ABBREVIATIONS), " ")


def store_id(name: Column, house_number: Column, road: Column, city: Column, state: Column) -> Column:
    fields = [norm_id_field(field) for field in (name, house_number, road, city, state)]
    return F.md5(F.concat_ws("|", *fields))


def api_eligible(state: Column) -> Column:
    return F.upper(blank_if_null(state)).isin(*API_STATES)
