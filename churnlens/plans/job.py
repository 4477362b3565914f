"""The retention job: load staging, publish production, append quality metrics.

Three actions, each a distributed write; only row counts and the one-row
metric summary come back to the driver. Every step can run as its own
``spark-submit`` (a scheduler chains them), or all three through
:meth:`RetentionELT.run_full_pipeline`.
"""

from __future__ import annotations

import logging
import os
import sys
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from churnlens.functions.expressions import utc_now
from churnlens.operators.quality import quality_metrics, reconcile_counts, to_tall
from churnlens.plans.ledger import resume_run
from churnlens.plans.production import build_production
from churnlens.schemas import METRIC_NAMES, METRICS, REJECTS, STAGING
from churnlens.sinks.incremental import KeyedTable, load_incremental, read_keyed
from churnlens.sinks.publish import append, publish
from churnlens.sources.csv_source import REJECT, accepted, read_source_csv, rejected, tag_source_csv
from churnlens.sources.tables import read_production, read_staging

log = logging.getLogger(__name__)


class RetentionELT:
    """Extract -> load -> transform -> metrics over three table locations.

    ``staging_path`` and ``production_path`` are base directories of
    versioned tables; ``metrics_path`` is an append-only parquet table
    (default: ``<production_path>_metrics``). ``ragged_csv="pad"`` accepts
    rows with missing trailing fields (see
    :func:`churnlens.sources.csv_source.read_text_csv`).

    With ``quarantine_path`` lines that do not parse do not fail the load:
    they are appended there with the reason (see
    :func:`churnlens.sources.csv_source.tag_source_csv`). With
    ``incremental`` a load merges the file's customers into the staging table
    by ``CustomerID`` and rewrites only the id ranges of ``staging_part_ids``
    that change; production is still published whole, since its fills come
    from statistics of all customers.
    """

    def __init__(
        self,
        spark: SparkSession,
        staging_path: str,
        production_path: str,
        csv_path: str,
        metrics_path: str | None = None,
        multiline_csv: bool = False,
        ragged_csv: str = "fail",
        quarantine_path: str | None = None,
        incremental: bool = False,
        staging_part_ids: int = 100_000,
    ):
        if quarantine_path and ragged_csv != "fail":
            raise ValueError("a quarantine takes rows of another length; it excludes ragged_csv")
        self.spark = spark
        self.staging_path = staging_path
        self.production_path = production_path
        self.csv_path = csv_path
        self.metrics_path = metrics_path or production_path.rstrip("/") + "_metrics"
        self.multiline_csv = multiline_csv
        self.ragged_csv = ragged_csv
        self.quarantine_path = quarantine_path
        self.keyed_staging = (
            KeyedTable(staging_path, STAGING, ("CustomerID",), f"CustomerID DIV {staging_part_ids}", ("load_timestamp",))
            if incremental
            else None
        )

    def staging(self) -> DataFrame:
        """The staging table; ``FileNotFoundError`` when nothing was loaded yet."""
        if self.keyed_staging:
            return read_keyed(self.spark, self.keyed_staging)
        return read_staging(self.spark, self.staging_path)

    @classmethod
    def from_paths(
        cls,
        staging_db_path: str,
        production_db_path: str,
        csv_path: str,
        spark: SparkSession | None = None,
        **options,
    ) -> "RetentionELT":
        """Construct from database-style path names; the session defaults to
        :func:`churnlens.session.get_spark`."""
        if spark is None:
            from churnlens.session import get_spark

            spark = get_spark("retention-elt")
        return cls(spark, staging_db_path, production_db_path, csv_path, **options)

    def extract_and_load(self) -> int:
        """CSV -> staging (full refresh, or a merge by id). Returns the number of rows loaded.

        Raises ``FileNotFoundError`` when the CSV is missing; a malformed file
        or a value that does not fit its column type fails the load (without a
        quarantine) and leaves the previous staging table in place.
        """
        log.info("Extract and load from %s", self.csv_path)
        if not self.quarantine_path:
            source = read_source_csv(
                self.spark, self.csv_path, multiline=self.multiline_csv, ragged=self.ragged_csv
            )
            return self._load(source)
        tagged = tag_source_csv(self.spark, self.csv_path, multiline=self.multiline_csv)
        obs = Observation("rejects")  # counted while the good rows are written
        bad = F.count_if(F.col(REJECT).isNotNull()).alias("rejected")
        rows = self._load(accepted(tagged.observe(obs, bad)))
        n_bad = int(obs.get["rejected"])
        if n_bad:
            append(rejected(tagged).withColumn("load_timestamp", utc_now()), self.quarantine_path, REJECTS)
            log.warning("Rejected %s lines of %s; see %s", n_bad, self.csv_path, self.quarantine_path)
        return rows

    def _load(self, source: DataFrame) -> int:
        staged = source.withColumn("load_timestamp", utc_now())
        if self.keyed_staging:
            result = load_incremental(staged, self.keyed_staging)
            log.info(
                "Merged %s rows into staging: %s new, %s changed, %s parts rewritten",
                result.rows, result.inserted, result.updated, len(result.parts),
            )
            return result.rows
        _, rows = publish(staged, self.staging_path, STAGING)
        log.info("Loaded %s rows to staging", rows)
        return rows

    def transform(self) -> int:
        """Staging -> production (full refresh). Returns the rows published.

        Raises ``FileNotFoundError`` when no staging table was loaded.
        """
        _, rows = publish(build_production(self.staging()), self.production_path)
        log.info("Loaded %s rows to production", rows)
        return rows

    def generate_data_quality_metrics(
        self, run_timestamp: Column | None = None, write: bool = True
    ) -> dict[str, Any]:
        """Compute the six metrics, append them to the history, return them.

        The returned values keep NULL (e.g. averages of an empty table); the
        stored values use 0 instead. All six rows of one run share one
        ``run_timestamp`` (default: now). Without ``write`` they are only computed.
        """
        production = read_production(self.spark, self.production_path)
        wide = quality_metrics(production)
        row = wide.collect()[0]  # a global aggregate: exactly one row
        metrics = {name: row[name] for name in METRIC_NAMES}
        if not write:
            return metrics
        one_row = self.spark.createDataFrame([row], wide.schema)
        tall = to_tall(one_row, run_timestamp=utc_now() if run_timestamp is None else run_timestamp)
        # Six rows: one file per run keeps the history (and its file stream) lean.
        append(tall.coalesce(1), self.metrics_path, METRICS)
        log.info("Generated metrics: %s", metrics)
        return metrics

    def run_full_pipeline(self, run_id: str | None = None) -> dict[str, Any]:
        """All three steps. Never raises: failures come back as a status dict.

        With a ``run_id`` each finished step is entered in the run ledger, and a
        rerun of the same id takes it up after the last one (see
        :class:`churnlens.plans.ledger.RunLedger`): tables are not published
        twice, and a run leaves one set of metric rows however often it is
        started.
        """
        if run_id is not None:
            return resume_run(self, run_id)
        try:
            staging_rows = self.extract_and_load()
            production_rows = self.transform()
            # a merged file is only a part of the staging table
            whole = self.staging().count() if self.keyed_staging else staging_rows
            reconcile_counts(whole, production_rows)
            metrics = self.generate_data_quality_metrics()
            return {
                "status": "success",
                "staging_rows": staging_rows,
                "production_rows": production_rows,
                "metrics": metrics,
            }
        except Exception as e:  # noqa: BLE001 - reported to the caller
            log.error("Pipeline failed: %s", e)
            return {"status": "failed", "error": str(e)}


STEPS = ("extract", "transform", "metrics", "all")


def run_step(job: RetentionELT, step: str, staging_rows: int | None = None) -> dict[str, Any]:
    """Run one step of the job in this process; raises when it fails.

    ``transform`` compares its row count with ``staging_rows``, or with a
    count of the staging table when a scheduler did not hand that over.
    """
    if step == "extract":
        return {"staging_rows": job.extract_and_load()}
    if step == "transform":
        rows = job.transform()
        if staging_rows is None or job.keyed_staging:
            staging_rows = job.staging().count()
        return {"production_rows": rows, "matches": reconcile_counts(staging_rows, rows)}
    if step == "metrics":
        return {"metrics": job.generate_data_quality_metrics()}
    raise ValueError(f"unknown step {step!r}; expected one of {STEPS}")


def main(argv: list[str] | None = None) -> int:
    """``spark-submit`` entry point: ``[--step STEP] [--staging-rows N]``.

    Paths come from the environment and must be set: ``STAGING_DB_PATH``,
    ``PRODUCTION_DB_PATH``, ``CSV_PATH`` (``METRICS_PATH`` is optional, and so is
    ``QUARANTINE_PATH``; ``--incremental`` merges the file into staging by id).
    Each step can run as its own application. Exit status 0 on success, 1 on
    failure, 2 when a setting is missing.
    """
    import argparse

    from churnlens.session import get_spark

    parser = argparse.ArgumentParser(description="Run the retention job or one of its steps.")
    parser.add_argument("--step", choices=STEPS, default="all")
    parser.add_argument("--staging-rows", type=int, help="rows the extract step loaded, for the check")
    parser.add_argument("--run-id", help="name of this run: a rerun takes it up after its last finished step")
    parser.add_argument("--incremental", action="store_true", help="merge the file into staging by CustomerID")
    args = parser.parse_args([] if argv is None else argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s")
    missing = [k for k in ("STAGING_DB_PATH", "PRODUCTION_DB_PATH", "CSV_PATH") if not os.environ.get(k)]
    if missing:
        log.error("Not set: %s", ", ".join(missing))
        return 2
    job = RetentionELT(
        get_spark("retention-elt"),
        staging_path=os.environ["STAGING_DB_PATH"],
        production_path=os.environ["PRODUCTION_DB_PATH"],
        csv_path=os.environ["CSV_PATH"],
        metrics_path=os.environ.get("METRICS_PATH"),
        quarantine_path=os.environ.get("QUARANTINE_PATH"),
        incremental=args.incremental,
    )
    if args.step != "all":
        try:
            log.info("Step %s: %s", args.step, run_step(job, args.step, args.staging_rows))
            return 0
        except Exception as e:  # noqa: BLE001 - reported by the exit status
            log.error("Step %s failed: %s", args.step, e)
            return 1
    result = job.run_full_pipeline(args.run_id)
    if result["status"] == "success":
        log.info("ELT job completed")
        return 0
    log.error("ELT job failed: %s", result.get("error"))
    return 1


def cli() -> int:
    return main(sys.argv[1:])


if __name__ == "__main__":
    sys.exit(cli())
