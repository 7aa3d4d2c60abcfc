"""Run ledger and step audit as append-only events.

Events and the states of runs lie in hash buckets of the run. An event is added to its bucket, whose files are put
together after ``MOST_FOLDERS`` events, and only the states of that bucket are written again: the files that an
event reads and writes do not become more with the number of runs.
"""

from __future__ import annotations

import datetime as dt
import functools
import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions import duration_seconds
from tierline.sinks.warehouse import BUCKET, Warehouse

log = logging.getLogger(__name__)

EVENTS = "metadata.pipeline_run_events"
RUNS = "metadata.pipeline_runs"
AUDIT = "metadata.audit_log"
MOST_FOLDERS = 16


def current_runs(events: DataFrame) -> DataFrame:
    """One row per run: the state of its last event and the sum of all its counts.

    Sums and the last event are both taken in one aggregate per run, so counts of a run that
    reports often are combined before the shuffle.
    """
    last = F.max_by(F.struct("status", "end_time"), F.struct("event_time", "status"))
    start = F.max_by("start_time", F.struct("start_time", "event_time"))
    return (
        events.groupBy("run_id")
        .agg(
            F.max("pipeline_name").alias("pipeline_name"),
            F.min("execution_date").alias("execution_date"),
            last.alias("_last"),
            start.alias("start_time"),
            *[
                F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c)
                for c in ("records_inserted", "records_updated", "records_rejected")
            ],
        )
        .select(
            "run_id",
            "pipeline_name",
            "execution_date",
            F.col("_last.status").alias("status"),
            "start_time",
            F.col("_last.end_time").alias("end_time"),
            duration_seconds(F.col("start_time"), F.col("_last.end_time")).alias(
                "duration_seconds"
            ),
            "records_inserted",
            "records_updated",
            "records_rejected",
        )
    )


def runs_by_status(runs: DataFrame) -> DataFrame:
    """Number of runs per pipeline and status."""
    return runs.groupBy("pipeline_name", "status").agg(F.count(F.lit(1)).alias("n"))


def latest_rows(df: DataFrame, order_col: str, tie: str, k: int = 20) -> DataFrame:
    """The k most recent metadata rows."""
    return df.orderBy(F.desc(order_col), F.desc(tie)).limit(k)


class RunLedger:
    """Writes run and audit events; failing to write one is logged and never stops a run."""

    def __init__(self, warehouse: Warehouse, run_id: str, pipeline: str, execution: dt.datetime):
        self.warehouse = warehouse
        self.run_id = run_id
        self.pipeline = pipeline
        self.execution = execution
        self.bucket: list[int] | None = None
        self.clock = lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)

    def _append(self, table: str, row: dict[str, object]) -> None:
        try:
            if table == EVENTS:
                self._add_event(self.warehouse.row(EVENTS, row))
            else:
                self.warehouse.append_row(table, row)
        except Exception:  # noqa: BLE001
            log.warning("could not write to %s", table, exc_info=True)

    def _add_event(self, event: DataFrame) -> None:
        wh = self.warehouse
        if self.bucket is None:
            self.bucket = wh.buckets_of(EVENTS, event)
        wh.write_more(EVENTS, event)
        wh.compact(EVENTS, MOST_FOLDERS)
        wh.write_buckets(RUNS, current_runs(wh.read(EVENTS, {BUCKET: self.bucket})), self.bucket)

    def _event(self, status: str, **values: object) -> None:
        row = {
            "run_id": self.run_id,
            "pipeline_name": self.pipeline,
            "execution_date": self.execution,
            "status": status,
            "event_time": self.clock(),
        }
        self._append(EVENTS, row | values)

    def start(self) -> None:
        self._event("RUNNING", start_time=self.clock())

    def finish(self, status: str, inserted: int = 0, updated: int = 0, rejected: int = 0) -> None:
        self._event(
            status,
            end_time=self.clock(),
            records_inserted=inserted,
            records_updated=updated,
            records_rejected=rejected,
        )

    def audit(self, task: str, step: str, status: str, rows: int = 0, message: str = "") -> None:
        """One audit line (R2); ``log_id`` grows with time."""
        self._append(
            AUDIT,
            {
                "log_id": time.time_ns(),
                "run_id": self.run_id,
                "task_name": task,
                "step_name": step,
                "status": status,
                "affected_rows": rows,
                "log_message": message,
                "log_timestamp": self.clock(),
            },
        )

    def audited(self, task: str, step: str) -> Callable:
        """Decorator: log start and end of a step that returns (affected rows, message)."""

        def wrap(fn: Callable) -> Callable:
            @functools.wraps(fn)
            def run(*args: object, **kwargs: object) -> object:
                self.audit(task, step, "STARTED")
                try:
                    result = fn(*args, **kwargs)
                except Exception as e:
                    self.audit(task, step, "FAILED", 0, f"Error: {e}")
                    raise
                self.audit(task, step, "COMPLETED", *result)
                return result

            return run

        return wrap


def ordered_audit(audit: DataFrame) -> DataFrame:
    """The audit log in the order it was written."""
    columns = ["task_name", "step_name", "status", "affected_rows", "log_message"]
    return audit.orderBy("log_id").select(*columns)
