"""Sources: CSV files, published tables, and inputs derived from the test tables."""

from churnlens.sources.csv_source import accepted, read_source_csv, read_text_csv, rejected, tag_source_csv, text_to_typed
from churnlens.sources.tables import read_metrics, read_production, read_staging

__all__ = [
    "accepted",
    "read_metrics",
    "read_production",
    "read_source_csv",
    "read_staging",
    "read_text_csv",
    "rejected",
    "tag_source_csv",
    "text_to_typed",
]
