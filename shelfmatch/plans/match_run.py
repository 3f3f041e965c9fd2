"""Match run: stores against all distributors' accounts, into the account universe."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from shelfmatch.operators import health
from shelfmatch.operators.matching import account_universe, find_matches
from shelfmatch.operators.merge import not_in
from shelfmatch.session import materialize, scratch_released, tune
from shelfmatch.sources.audit_log import AuditLog
from shelfmatch.sources.tables import KeyedTable

COMPONENT = "store-matching"
MODES = ("incremental", "full")


def stores_to_match(stores: DataFrame, universe: DataFrame, mode: str) -> DataFrame:
    return not_in(stores, universe) if mode == "incremental" else stores


def count_stores(stores: DataFrame) -> DataFrame:
    return stores.agg(F.countDistinct("store_id").alias("stores"))


@dataclass(frozen=True)
class RunResult:
    processed: int
    matched: int


def run_matching(stores: DataFrame, accounts: DataFrame, table: KeyedTable, audit: AuditLog,
                 mode: str = "incremental", now: datetime | None = None) -> RunResult:
    if mode not in MODES:
        raise ValueError(f"mode {mode!r} is not one of {MODES}")
    now = now or datetime.now(timezone.utc)
    tune(audit.spark)
    with audit.recording(COMPONENT, {"mode": mode}), scratch_released(audit.spark):
        result = _match(stores, accounts, table, audit, mode, now)
    audit.log_run(COMPONENT, mode=mode, rows=result.processed)
    return result


def _match(stores: DataFrame, accounts: DataFrame, table: KeyedTable, audit: AuditLog, mode: str,
           now: datetime) -> RunResult:
    """An incremental run reads the table's keys, where they lie, and writes its new rows only."""
    todo = materialize(stores_to_match(stores, table.keys(), mode), "to-match")
    if todo.isEmpty():
        return RunResult(0, 0)
    counts = Observation()  # counted while the result is written
    matched = account_universe(find_matches(todo, accounts), F.lit(now), F.to_date(F.lit(now)))
    fresh = materialize(matched.observe(counts, *health.counters()), "universe")
    if mode == "incremental":
        table.upsert(fresh)
    else:
        table.replace(fresh)  # not empty: an empty load has returned above
        empty = health.zero_match_violation(audit.spark.createDataFrame([counts.get], "processed long, matched long"))
        audit.log_violations(
            empty.select(F.lit(COMPONENT).alias("component"), F.lit("zero_stores_matched").alias("check_name"),
                         F.format_string("no match among %d stores", "processed").alias("message"),
                         "processed", "matched"),
            context=F.to_json(F.struct("processed", "matched")))
    return RunResult(counts.get["processed"], counts.get["matched"])
