"""Error and run logs. Recording never breaks the job it records."""

from __future__ import annotations

import logging
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.functions.audit import hex_id
from shelfmatch.schemas import PIPELINE_ERRORS, PIPELINE_RUNS
from shelfmatch.sources.tables import AppendTable

log = logging.getLogger(__name__)


def _text(value: str | None) -> Column:
    return F.lit(value).cast("string")


class AuditLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.errors = AppendTable(spark, f"{root}/pipeline_errors", PIPELINE_ERRORS, "occurred_at")
        self.runs = AppendTable(spark, f"{root}/pipeline_runs", PIPELINE_RUNS, "finished_at")

    def _append(self, table: AppendTable, rows: DataFrame) -> bool:
        try:
            table.append(rows)
            return True
        except Exception:
            log.exception("audit rows not written to %s", table.root)
            return False

    def log_violations(self, violations: DataFrame, *, severity: str = "ERROR", test_type: str = "function",
                       context: Column | None = None, run_id: str | None = None, now: Column | None = None) -> bool:
        """One error row per violation ``component, check_name, message``; a whole check's rows in one write."""
        rows = violations.select(
            hex_id().alias("error_id"), (F.current_timestamp() if now is None else now).alias("occurred_at"),
            "component", "check_name", "message", _text(test_type).alias("test_type"),
            _text(severity).alias("severity"), (_text(None) if context is None else context).alias("context"),
            _text(run_id).alias("run_id"))
        return self._append(self.errors, rows)

    def log_error(self, component: str, check_name: str, message: str, *, severity: str = "ERROR",
                  test_type: str = "function", context: dict | None = None, run_id: str | None = None) -> bool:
        one = self.spark.range(1).select(
            _text(component).alias("component"), _text(check_name).alias("check_name"), _text(message).alias("message"))
        detail = None
        if context is not None:
            detail = F.to_json(F.struct(*[F.lit(value).alias(name) for name, value in context.items()]))
        return self.log_violations(one, severity=severity, test_type=test_type, context=detail, run_id=run_id)

    def log_run(self, component: str, status: str = "success", *, mode: str | None = None, rows: int | None = None,
                run_id: str | None = None) -> bool:
        row = self.spark.range(1).select(
            (hex_id() if run_id is None else _text(run_id)).alias("run_id"), _text(component).alias("component"),
            _text(mode).alias("mode"), _text(status).alias("status"),
            F.lit(rows).cast("long").alias("rows_processed"), F.current_timestamp().alias("finished_at"))
        return self._append(self.runs, row)

    @contextmanager
    def recording(self, component: str, context: dict | None = None) -> Iterator[None]:
        """An exception inside becomes an error row and goes on to the caller."""
        try:
            yield
        except Exception as error:
            self.log_error(component, "unhandled_exception", str(error), test_type="infrastructure", context=context)
            raise
