"""Restarting a run after its last finished step.

A run has a name, chosen by whoever starts it (the scheduled time, say). The
ledger is a small append-only table beside the production table: one row per
finished step with the rows it handled, written after the step's own commit.
A rerun of the same name skips steps that are in it. A step that died between
its commit and its entry is run again, which changes nothing: a refresh
publishes the same table, a merge by key finds nothing new, and metric rows
carry the run's own time, which is entered before they are appended, so they
are looked for before they are written again.
"""

from __future__ import annotations

import json
import logging
from datetime import datetime
from typing import TYPE_CHECKING, Any

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.functions.expressions import utc_now
from churnlens.operators.quality import reconcile_counts
from churnlens.sinks.history import read_history
from churnlens.sinks.publish import append
from churnlens.sinks.storage import path_exists
from churnlens.sources.tables import read_metrics

if TYPE_CHECKING:
    from churnlens.plans.job import RetentionELT

log = logging.getLogger(__name__)

LEDGER = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("step", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("result", T.StringType()),
        T.StructField("finished_at", T.TimestampNTZType()),
    ]
)
START, EXTRACT, TRANSFORM, METRICS_STEP = "start", "extract", "transform", "metrics"


class RunLedger:
    """Finished steps of the runs of one job."""

    def __init__(self, spark: SparkSession, path: str, run_id: str):
        self.spark, self.path, self.run_id = spark, path, run_id

    def entries(self) -> dict[str, dict[str, Any]]:
        """The run's finished steps (the first entry of each counts)."""
        if not path_exists(self.spark, self.path):
            return {}
        own = read_history(self.spark, self.path, LEDGER).filter(F.col("run_id") == self.run_id)
        rows = own.groupBy("step").agg(F.min_by(F.struct(*LEDGER.names), "finished_at").alias("row")).collect()  # a row a step
        return {r["step"]: r["row"].asDict() for r in rows}

    def enter(self, step: str, rows: int, result: dict[str, Any] | None = None) -> None:
        text = None if result is None else json.dumps(result, default=str)
        row = self.spark.createDataFrame([(self.run_id, step, rows, text)], "run_id string, step string, rows long, result string")
        append(row.withColumn("finished_at", utc_now()).coalesce(1), self.path, LEDGER)


def ledger_path(job: RetentionELT) -> str:
    return job.production_path.rstrip("/") + "_runs"


def _metric_rows(job: RetentionELT, at: datetime) -> bool:
    """Whether the history has the rows of the run that started at ``at``."""
    if not path_exists(job.spark, job.metrics_path):
        return False
    return not read_metrics(job.spark, job.metrics_path).filter(F.col("run_timestamp") == F.lit(at)).isEmpty()


def resume_run(job: RetentionELT, run_id: str) -> dict[str, Any]:
    """Run the steps of ``run_id`` that are not finished; never raises, like the full pipeline."""
    ledger = RunLedger(job.spark, ledger_path(job), run_id)
    try:
        done = ledger.entries()
        if START not in done:
            ledger.enter(START, 0)
            done = ledger.entries()
        if EXTRACT not in done:
            rows = job.extract_and_load()
            ledger.enter(EXTRACT, rows)
        else:
            rows = done[EXTRACT]["rows"]
            log.info("Run %s: %s rows were loaded before", run_id, rows)
        if TRANSFORM not in done:
            published = job.transform()
            ledger.enter(TRANSFORM, published)
        else:
            published = done[TRANSFORM]["rows"]
        reconcile_counts(job.staging().count() if job.keyed_staging else rows, published)
        if METRICS_STEP in done:
            metrics = json.loads(done[METRICS_STEP]["result"])
        else:
            # the run's start is the time of its metric rows: it is the same in every rerun
            at = done[START]["finished_at"]
            metrics = job.generate_data_quality_metrics(F.lit(at), write=not _metric_rows(job, at))
            ledger.enter(METRICS_STEP, len(metrics), metrics)
        return {"status": "success", "staging_rows": rows, "production_rows": published, "metrics": metrics}
    except Exception as e:  # noqa: BLE001 - reported to the caller
        log.error("Run %s failed: %s", run_id, e)
        return {"status": "failed", "error": str(e)}
