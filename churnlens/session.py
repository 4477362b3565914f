"""Spark session with defaults suited to this job; explicit settings win."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Applied only when neither the cluster (spark-defaults, --conf) nor the
# caller set them. Nothing in the library depends on the session time zone
# (all timestamps are zone-less), so it is left alone.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(app: str = "churnlens", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """Get or create the session, filling in :data:`DEFAULTS` where not set explicitly."""
    conf = dict(conf or {})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    explicit = spark.sparkContext.getConf()
    for k, v in DEFAULTS.items():
        if k in conf or explicit.contains(k):
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # noqa: BLE001 - static confs cannot change at runtime
            pass
    return spark
