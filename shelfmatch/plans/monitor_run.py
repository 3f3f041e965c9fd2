"""Freshness monitor: components whose last success is missing or too old become error rows."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.operators.health import MAX_AGE_HOURS, run_ages, stale_components
from shelfmatch.plans import geocode_run, match_run
from shelfmatch.session import materialize, scratch_released, tune
from shelfmatch.sources.audit_log import AuditLog

COMPONENT = "pipeline-monitor"
WATCHED = ((match_run.COMPONENT, MAX_AGE_HOURS), (geocode_run.COMPONENT, MAX_AGE_HOURS))


def component_ages(audit: AuditLog, checks: DataFrame, now: Column) -> DataFrame:
    """Ages of the last successes, read from the last days' heartbeats; older ones only for components not found there."""
    hours = checks.agg(F.max("max_age_hours")).first()[0] or 0
    recent = materialize(run_ages(checks, audit.runs.read(since=now - F.make_interval(hours=F.lit(hours + 24))), now), "ages")
    unseen = recent.filter("age_hours is null")
    if unseen.isEmpty():
        return recent
    older = run_ages(unseen.select("component", "max_age_hours"), audit.runs.read(), now)
    return recent.filter("age_hours is not null").unionByName(older)


def run_monitor(audit: AuditLog, now: Column | None = None, watched=WATCHED) -> int:
    """Number of problems logged. The monitor leaves a heartbeat of its own, so its own death shows."""
    spark = tune(audit.spark)
    with audit.recording(COMPONENT), scratch_released(spark):
        checks = spark.createDataFrame(list(watched), "component string, max_age_hours int")
        moment = F.lit(datetime.now(timezone.utc)) if now is None else now
        found = materialize(stale_components(component_ages(audit, checks, moment)), "stale")
        if not found.isEmpty():
            audit.log_violations(
                found, test_type="infrastructure",
                context=F.to_json(F.struct("component", "age_hours", "max_age_hours")))
        problems = found.count()
    audit.log_run(COMPONENT)
    return problems
