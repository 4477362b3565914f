"""Staging -> production: clean, anonymise, derive, stamp, conform (one lazy plan)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from churnlens.functions.expressions import utc_now
from churnlens.operators.anonymize import anonymize_uuid
from churnlens.operators.conform import conform
from churnlens.operators.derive import derive_features
from churnlens.operators.impute import impute
from churnlens.schemas import (
    FILL_CONSTANTS,
    FILL_MEAN,
    FILL_MEDIAN_INT,
    PRODUCTION,
    PRODUCTION_COMPARABLE,
)


def clean_and_derive(staging: DataFrame) -> DataFrame:
    """Fill missing values, then add the churn flag and the range bands.

    Charges are filled with the unrounded mean and binned before they are
    rounded to cents (the rounding happens in :func:`conform`).
    """
    filled = impute(
        staging,
        constants=FILL_CONSTANTS,
        median_int=FILL_MEDIAN_INT,
        median_method="exact",  # ages: few distinct values
        mean=FILL_MEAN,
    )
    return derive_features(filled)


def production_comparable(staging: DataFrame) -> DataFrame:
    """The deterministic part of production, keyed by ``CustomerID``."""
    return conform(clean_and_derive(staging), PRODUCTION_COMPARABLE)


def build_production(staging: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Full production table from a staging frame (lazy; write it once).

    ``AnonymizedCustomerID`` is a random UUID per row replacing
    ``CustomerID``; ``processed_timestamp`` is one value for the whole run.
    """
    cleaned = clean_and_derive(staging)
    anonymous = anonymize_uuid(cleaned, "CustomerID", "AnonymizedCustomerID")
    stamped = anonymous.withColumn(
        "processed_timestamp", processed_at if processed_at is not None else utc_now()
    )
    return conform(stamped, PRODUCTION)
