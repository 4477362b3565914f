"""The metric monitor as a stream over the history written by real job runs."""

from __future__ import annotations

from churnlens.plans.job import RetentionELT
from churnlens.sinks import current_version_path, read_published
from churnlens.streaming import start_metrics_monitor
from pyspark.sql import types as T


def test_monitor_tracks_latest_run(spark, paths, f1_csv, tmp_path):
    elt = RetentionELT(spark, paths["staging"], paths["production"], f1_csv, paths["metrics"])
    assert elt.run_full_pipeline()["status"] == "success"
    out, ckpt = str(tmp_path / "monitor"), str(tmp_path / "monitor_ckpt")

    q = start_metrics_monitor(spark, paths["metrics"], out, ckpt, available_now=True)
    q.awaitTermination(120)
    schema = T.StructType(
        [
            T.StructField("metric_name", T.StringType()),
            T.StructField("last_metric_value", T.DecimalType(18, 2)),
            T.StructField("last_run_timestamp", T.TimestampNTZType()),
            T.StructField("band", T.StringType()),
        ]
    )
    snap = {r["metric_name"]: r for r in read_published(spark, out, schema).collect()}
    assert float(snap["total_records"]["last_metric_value"]) == 6.0
    assert float(snap["churn_rate_percent"]["last_metric_value"]) == 33.33
    assert snap["churn_rate_percent"]["band"] == "green"
    assert snap["total_records"]["band"] is None

    # A second run appends new history; restarting from the checkpoint only
    # reads the new files and the snapshot moves to the newer run.
    first_ts = snap["total_records"]["last_run_timestamp"]
    assert elt.run_full_pipeline()["status"] == "success"
    alerts_out = str(tmp_path / "alerts")
    q = start_metrics_monitor(
        spark, paths["metrics"], out, ckpt, available_now=True, alerts_base=alerts_out
    )
    q.awaitTermination(120)
    alerts = spark.read.parquet(current_version_path(spark, alerts_out)).collect()
    assert len(alerts) == 6
    volume = [r for r in alerts if r["metric_name"] == "total_records"][0]
    assert volume["volume_alert"] is False and volume["pct_change"] == 0.0
    assert all(r["sigma_alert"] is None for r in alerts)  # one earlier run only
    snap2 = {r["metric_name"]: r for r in read_published(spark, out, schema).collect()}
    assert snap2["total_records"]["last_run_timestamp"] > first_ts
    assert len(snap2) == 6
