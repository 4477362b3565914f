"""DataFrame -> DataFrame operators (lazy, native expressions only)."""

from churnlens.operators.anonymize import anonymize_hash, anonymize_uuid
from churnlens.operators.conform import conform
from churnlens.operators.derive import derive_features
from churnlens.operators.display import display_round, rate_band, select_field, table_band
from churnlens.operators.impute import impute, most_frequent, null_census
from churnlens.operators.changes import detect_changes, one_per_key, row_difference
from churnlens.operators.moments import advanced_state, incremental_alerts, merged_state, metric_state
from churnlens.operators.quality import (
    last_not_null,
    latest_metrics,
    metric_alerts,
    metric_trend,
    quality_metrics,
    reconcile,
    reconcile_counts,
    to_tall,
)
from churnlens.operators.reports import (
    band_counts,
    distinct_values,
    segment_profile,
    segment_rate,
    segment_rates,
    segment_totals,
    summary,
    to_json_lines,
)

__all__ = [
    "advanced_state",
    "detect_changes",
    "incremental_alerts",
    "merged_state",
    "metric_state",
    "one_per_key",
    "row_difference",
    "anonymize_hash",
    "anonymize_uuid",
    "band_counts",
    "conform",
    "derive_features",
    "distinct_values",
    "display_round",
    "impute",
    "most_frequent",
    "last_not_null",
    "latest_metrics",
    "metric_alerts",
    "metric_trend",
    "null_census",
    "quality_metrics",
    "rate_band",
    "reconcile",
    "reconcile_counts",
    "segment_profile",
    "segment_rate",
    "segment_rates",
    "segment_totals",
    "select_field",
    "summary",
    "table_band",
    "to_json_lines",
    "to_tall",
]
