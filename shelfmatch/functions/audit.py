"""Columns of audit rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hex_id() -> Column:
    return F.regexp_replace(F.uuid(), "-", "")


def context_json(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields))


def elapsed_hours(since: Column, until: Column) -> Column:
    """Whole hours, cut off."""
    return F.timestamp_diff("HOUR", since, until)


def run_stamp(now: Column) -> Column:
    """Sortable run id."""
    return F.date_format(now, "yyyyMMdd_HHmmss")
