"""Live view of the metric history: newest value per metric, with its band.

The metric history is an append-only parquet table, so it is read as a file
stream: every job run adds files, every trigger picks them up and reads
nothing else. What earlier runs leave behind is one row per metric, merged
with the new rows: the newest non-NULL value, and the moments that alerts are
judged by. Each trigger publishes the full snapshot as a new version of a
small table (see :func:`churnlens.sinks.publish.publish`), so a dashboard
always reads a complete, consistent set of KPIs. Replaying an epoch after a
failure publishes the same snapshot again; the alert state remembers the
epoch that it holds, so its rows never count twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from churnlens.functions.expressions import band_left_closed
from churnlens.operators.moments import advanced_state, incremental_alerts, metric_state
from churnlens.operators.quality import last_not_null, metric_alerts
from churnlens.schemas import METRIC_STATE, METRIC_VALUE, METRICS, RATE_BANDS, RATE_BASE_BAND
from churnlens.sinks.history import read_history
from churnlens.sinks.publish import committed_versions, publish, read_published, vacuum

SNAPSHOT = T.StructType(
    [
        T.StructField("metric_name", T.StringType()),
        T.StructField("last_metric_value", METRIC_VALUE),
        T.StructField("last_run_timestamp", T.TimestampNTZType()),
        T.StructField("band", T.StringType()),
    ]
)
# The metric state, and the stream and epoch it holds.
MONITOR_STATE = T.StructType(
    [*METRIC_STATE.fields, T.StructField("stream", T.StringType()), T.StructField("epoch", T.LongType())]
)

# Metrics that are percentages and get a colour band.
BANDED_METRICS = ("churn_rate_percent",)


def latest_metric_values(history_stream: DataFrame) -> DataFrame:
    """Per metric: newest non-NULL value and its run time, plus the display band."""
    latest = last_not_null(history_stream, "metric_name", "metric_value", ["run_timestamp"])
    return latest.withColumn(
        "band",
        F.when(
            F.col("metric_name").isin(list(BANDED_METRICS)),
            band_left_closed("last_metric_value", RATE_BANDS, RATE_BASE_BAND),
        ),
    )


def newest_run_alerts(history: DataFrame) -> DataFrame:
    """The alert rows (see :func:`metric_alerts`) of the newest run only."""
    newest = history.agg(F.max("run_timestamp")).scalar()
    return metric_alerts(history).where(F.col("run_timestamp") == newest)


def metric_history_stream(
    spark: SparkSession, metrics_path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(METRICS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(metrics_path)


def _snapshot(spark: SparkSession, output_base: str, metrics_path: str, rows: DataFrame) -> DataFrame:
    """The newest values so far, merged with those of some more rows."""
    if not committed_versions(spark, output_base):
        # once: files that were compacted and deleted never come through the stream
        return latest_metric_values(read_history(spark, metrics_path, METRICS))
    before = read_published(spark, output_base, SNAPSHOT).select(
        "metric_name", F.col("last_metric_value").alias("metric_value"), F.col("last_run_timestamp").alias("run_timestamp")
    )
    return latest_metric_values(before.unionByName(rows))


def _alert_state(
    spark: SparkSession, state_base: str, history: DataFrame, rows: DataFrame, stream: str, epoch: int
) -> DataFrame | None:
    """The metric state that ``rows`` come after; None when they are in it already (a replayed epoch)."""
    if committed_versions(spark, state_base):
        stored = read_published(spark, state_base, MONITOR_STATE)
        seen = stored.select("stream", "epoch").first()
        if seen and seen["stream"] == stream:
            return None if seen["epoch"] >= epoch else stored.select(*METRIC_STATE.names)
    # a new stream: what lies before its rows is summarised once
    first = rows.agg(F.min("run_timestamp")).scalar()
    return metric_state(history.where(F.col("run_timestamp") < first))


def start_metrics_monitor(
    spark: SparkSession,
    metrics_path: str,
    output_base: str,
    checkpoint_location: str | None = None,
    refresh_seconds: int = 30,
    available_now: bool = False,
    alerts_base: str | None = None,
    keep_seconds: float = 86_400,
) -> StreamingQuery:
    """Start the monitor; returns the running query.

    ``checkpoint_location`` must be on shared storage; when omitted Spark
    uses ``spark.sql.streaming.checkpointLocation`` (and refuses to start if
    that is unset). ``available_now`` processes what is there and stops
    (for scheduled or test runs); otherwise it refreshes every
    ``refresh_seconds``. With ``alerts_base``, each trigger also publishes the
    alert rows of the newest run, judged by the state of all runs before
    (``alerts_base`` + ``_state``, one row per metric). Snapshots replaced more
    than ``keep_seconds`` ago are vacuumed; choose it above the longest read.
    """
    state_base = f"{alerts_base.rstrip('/')}_state" if alerts_base else None

    def publish_snapshot(rows: DataFrame, epoch: int) -> None:
        publish(_snapshot(spark, output_base, metrics_path, rows), output_base)
        vacuum(spark, output_base, keep_seconds)
        if not alerts_base:
            return
        stream = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        history = read_history(spark, metrics_path, METRICS)
        state = _alert_state(spark, state_base, history, rows, stream, epoch)
        if state is None:
            return
        newest = rows.agg(F.max("run_timestamp")).scalar()
        publish(incremental_alerts(state, rows).where(F.col("run_timestamp") == newest), alerts_base)
        # the state moves last: a failure before it replays this epoch with the same result
        advanced = advanced_state(state, rows).withColumns({"stream": F.lit(stream), "epoch": F.lit(epoch).cast("long")})
        publish(advanced, state_base, MONITOR_STATE)
        for base in (alerts_base, state_base):
            vacuum(spark, base, keep_seconds)

    stream_rows = metric_history_stream(spark, metrics_path)
    writer = stream_rows.writeStream.outputMode("append").foreachBatch(publish_snapshot)
    if checkpoint_location:
        writer = writer.option("checkpointLocation", checkpoint_location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{refresh_seconds} seconds")
    return writer.queryName("churnlens_metrics_monitor").start()
