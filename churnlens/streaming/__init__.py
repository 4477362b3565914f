"""Streaming view over the append-only metric history."""

from churnlens.streaming.metrics_monitor import (
    latest_metric_values,
    metric_history_stream,
    newest_run_alerts,
    start_metrics_monitor,
)

__all__ = [
    "latest_metric_values",
    "metric_history_stream",
    "newest_run_alerts",
    "start_metrics_monitor",
]
