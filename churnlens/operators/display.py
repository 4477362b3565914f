"""Presentation rules of the KPI dashboard, as columns of the report frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.functions.expressions import band_left_closed
from churnlens.schemas import RATE_BANDS, RATE_BASE_BAND, TABLE_BANDS


def rate_band(
    df: DataFrame,
    rate_col: str = "churn_rate",
    out_col: str = "rate_band",
    bands: Sequence[tuple[float, str]] = RATE_BANDS,
    base: str = RATE_BASE_BAND,
) -> DataFrame:
    """Colour band of a percentage: ``red`` >= 80, ``yellow`` >= 50, else ``green``."""
    return df.withColumn(out_col, band_left_closed(rate_col, bands, base))


def table_band(df: DataFrame, rate_col: str = "churn_rate", out_col: str = "table_band") -> DataFrame:
    """Colour band of the segment table: ``red`` >= 80, else ``green``."""
    return rate_band(df, rate_col, out_col, TABLE_BANDS, RATE_BASE_BAND)


def display_round(df: DataFrame, col: str, decimals: int = 1, out_col: str | None = None) -> DataFrame:
    """Round a value for display (e.g. average tenure to 1 decimal)."""
    return df.withColumn(out_col or col, F.round(F.col(col), decimals))


def select_field(df: DataFrame, pattern: str) -> DataFrame:
    """Columns whose name matches a regular expression (e.g. ``^churn_rate$``)."""
    return df.select(df.colRegex(f"`{pattern}`"))
