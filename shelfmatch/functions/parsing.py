"""Typed reads of text fields. Input that does not parse gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmatch.functions.text import blank_if_null, null_if_blank, strip

# Accepted spellings of booleans, and of decimal numbers (digits may be grouped by underscores).
TRUE_WORDS = ("true", "1", "yes", "y")
FALSE_WORDS = ("false", "0", "no", "n", "")
_DIGITS = r"[0-9]+(_[0-9]+)*"
NUMBER = rf"^[+-]?({_DIGITS}\.?({_DIGITS})?|\.{_DIGITS})([eE][+-]?{_DIGITS})?$"


def parse_bool(value: Column) -> Column:
    word = F.lower(strip(blank_if_null(value)))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def parse_float(value: Column) -> Column:
    text = strip(value)
    number = F.regexp_replace(text, "_", "").try_cast("double")
    finite = number.between(F.lit(-1.7976931348623157e308), F.lit(1.7976931348623157e308))
    return F.when(text.rlike(NUMBER) & finite, number)


def parse_int(value: Column) -> Column:
    """Through float, cut towards zero."""
    return parse_float(value).try_cast("long")


def parse_text(value: Column) -> Column:
    return null_if_blank(value)
