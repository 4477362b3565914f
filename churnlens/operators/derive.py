"""Derived analytical columns: churn flag and range bands."""

from __future__ import annotations

from pyspark.sql import DataFrame

from churnlens.functions.expressions import bin_right_closed, flag_equals
from churnlens.schemas import (
    CHARGE_EDGES,
    CHARGE_LABELS,
    CHURN_YES,
    OUTSIDE_LABEL,
    TENURE_EDGES,
    TENURE_LABELS,
)


def derive_features(
    df: DataFrame,
    churn_col: str = "Churn",
    charges_col: str = "MonthlyCharges",
    tenure_col: str = "Tenure",
    outside: str = OUTSIDE_LABEL,
) -> DataFrame:
    """Add ``ChurnFlag``, ``MonthlyChargesCategory`` and ``TenureCategory``.

    Bands are right-closed: charges ``(0,50] (50,100] (100,inf)`` and tenure
    ``(0,12] (12,36] (36,inf)``; anything else (0, negatives, NULL) gets
    ``outside``.
    """
    return df.withColumns(
        {
            "ChurnFlag": flag_equals(churn_col, CHURN_YES),
            "MonthlyChargesCategory": bin_right_closed(
                charges_col, CHARGE_EDGES, CHARGE_LABELS, outside
            ),
            "TenureCategory": bin_right_closed(tenure_col, TENURE_EDGES, TENURE_LABELS, outside),
        }
    )
