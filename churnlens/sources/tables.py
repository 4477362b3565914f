"""Readers for the three published tables (read-only access)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnlens.schemas import METRICS, PRODUCTION, STAGING
from churnlens.sinks.history import read_history
from churnlens.sinks.publish import read_published


def read_staging(spark: SparkSession, base: str) -> DataFrame:
    """Current staging table; ``FileNotFoundError`` when nothing was loaded yet."""
    return read_published(spark, base, STAGING)


def read_production(spark: SparkSession, base: str) -> DataFrame:
    """Current production table; ``FileNotFoundError`` when never published."""
    return read_published(spark, base, PRODUCTION)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The metric history (append-only, maybe compacted); ``FileNotFoundError`` when absent."""
    return read_history(spark, path, METRICS)


# Default SQL names of the three tables.
VIEW_NAMES = ("staging", "production", "metric_history")


def register_views(
    spark: SparkSession,
    staging_base: str | None = None,
    production_base: str | None = None,
    metrics_path: str | None = None,
    view_names: tuple[str, str, str] = VIEW_NAMES,
) -> list[str]:
    """Expose the current table versions as temporary views for ``spark.sql``.

    Returns the names registered. Views are plans, not copies: a query reads
    the files of the version that was current at registration.
    """
    names = []
    for base, reader, view in (
        (staging_base, read_staging, view_names[0]),
        (production_base, read_production, view_names[1]),
        (metrics_path, read_metrics, view_names[2]),
    ):
        if base:
            reader(spark, base).createOrReplaceTempView(view)
            names.append(view)
    return names
