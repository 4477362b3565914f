"""KPI and segment reports over the production table.

Each report is one aggregate; every aggregate function used (count, sum,
max) merges partial results, so even a segment key with a handful of values
holding most rows is combined map-side and only a few rows per task are
shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.functions.expressions import (
    exact_avg,
    falsy_to_zero,
    rate_percent,
    rate_percent_null_as_zero,
)


def snake(name: str) -> str:
    """``ContractType`` -> ``contract_type``."""
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower()


def summary(
    df: DataFrame,
    flag: str = "ChurnFlag",
    charges: str = "MonthlyCharges",
    tenure: str = "Tenure",
) -> DataFrame:
    """One row: customer count, churn rate %, average charges, average tenure.

    Rates and averages are rounded to 2 decimals; a NULL (empty table) or a
    zero is reported as 0. A NULL flag is left out of the churn rate.
    """
    return df.agg(
        F.count(F.lit(1)).alias("total_customers"),
        falsy_to_zero(F.round(rate_percent(flag), 2)).alias("churn_rate"),
        falsy_to_zero(F.round(exact_avg(charges), 2)).alias("avg_monthly_charges"),
        falsy_to_zero(F.round(exact_avg(tenure), 2)).alias("avg_tenure"),
    )


def segment_rate(
    df: DataFrame,
    key: str = "ContractType",
    flag: str = "ChurnFlag",
    key_alias: str | None = None,
) -> DataFrame:
    """Per segment: row count and churn rate %, riskiest segment first.

    Output ``(<key_alias>, count, churn_rate)``; the key alias defaults to
    the key in snake case. The rate is rounded to 2 decimals, a NULL rate is
    reported as 0. A NULL key forms its own segment. Ties are broken by the
    segment key so the order is total.
    """
    key_alias = key_alias or snake(key)
    grouped = df.groupBy(F.col(key).alias(key_alias)).agg(
        F.count(F.lit(1)).alias("count"),
        F.round(rate_percent(flag), 2).alias("churn_rate"),
    )
    return grouped.orderBy(
        F.desc_nulls_last("churn_rate"), F.asc_nulls_last(key_alias)
    ).select(key_alias, "count", falsy_to_zero("churn_rate").alias("churn_rate"))


def segment_rates(
    df: DataFrame,
    keys: tuple[str, ...] | list[str],
    flag: str = "ChurnFlag",
) -> DataFrame:
    """:func:`segment_rate` for several segment keys at once, in one pass.

    One aggregation over grouping sets (one scan, one shuffle) instead of a
    union of per-key reports that would each recompute the input. Output
    ``(segment_key, segment, count, churn_rate)``: the key's name, the
    segment value as text, its row count and rounded churn rate (NULL -> 0).
    Ordered by key (in the given order), then riskiest segment first.
    """
    keys = list(keys)
    n = len(keys)
    gid = F.grouping_id()
    # Counts and sums add up: group by all keys first (categories, so few
    # rows), then expand those rows to the grouping sets, not the input's.
    cells = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"),
        F.sum(flag).alias("__hits"),
        F.count(flag).alias("__known"),
    )
    rate = F.try_divide(F.sum("__hits").cast("double"), F.sum("__known")) * F.lit(100)
    grouped = cells.groupingSets([[k] for k in keys], *keys).agg(
        F.sum("__n").alias("count"),
        F.round(rate, 2).alias("churn_rate"),
        gid.alias("__gid"),
    )
    # In the set of key i only that key is grouped: its grouping bit is 0.
    full = (1 << n) - 1
    which = {full - (1 << (n - 1 - i)): i for i in range(n)}
    key_name = value = order = None
    for g, i in which.items():
        cond = F.col("__gid") == F.lit(g)
        k_name, k_val, k_ord = F.lit(keys[i]), F.col(keys[i]).cast("string"), F.lit(i)
        if key_name is None:
            key_name, value, order = F.when(cond, k_name), F.when(cond, k_val), F.when(cond, k_ord)
        else:
            key_name, value, order = key_name.when(cond, k_name), value.when(cond, k_val), order.when(cond, k_ord)
    return grouped.select(
        key_name.alias("segment_key"),
        value.alias("segment"),
        "count",
        "churn_rate",
        order.alias("__order"),
    ).orderBy(
        "__order", F.desc_nulls_last("churn_rate"), F.asc_nulls_last("segment")
    ).select(
        "segment_key", "segment", "count", falsy_to_zero("churn_rate").alias("churn_rate")
    )


def segment_totals(df: DataFrame, key: str = "ContractType", flag: str = "ChurnFlag") -> DataFrame:
    """Per segment: row count and sum of the flag (NULL flags add nothing;
    a segment with only NULL flags sums to NULL), in ascending key order."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count"), F.sum(flag).alias("churned")).orderBy(
        F.asc_nulls_last(key)
    )


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """The distinct values of a column in ascending order, NULL last."""
    return df.select(col).distinct().orderBy(F.asc_nulls_last(col))


def segment_profile(
    df: DataFrame,
    key: str = "ContractType",
    flag: str = "ChurnFlag",
    charges: str = "MonthlyCharges",
    tenure: str = "Tenure",
    segment: str = "contract",
) -> DataFrame:
    """Per segment: count, churn rate %, average charges and tenure, unrounded.

    Output fields ``total_customers, churn_rate, avg_monthly_charges,
    avg_tenure, <segment>_type, <segment>_count, <segment>_churn_rate``.
    ``total_customers`` is the segment's count (not a grand total) and the
    two churn-rate fields are equal. Here a NULL flag counts as "not
    churned". NULL averages are reported as 0. No order.
    """
    rate = falsy_to_zero(rate_percent_null_as_zero(flag))
    n = F.count(F.lit(1))
    return df.groupBy(key).agg(
        n.alias("total_customers"),
        rate.alias("churn_rate"),
        falsy_to_zero(exact_avg(charges)).alias("avg_monthly_charges"),
        falsy_to_zero(exact_avg(tenure)).alias("avg_tenure"),
        n.alias(f"{segment}_count"),
        rate.alias(f"{segment}_churn_rate"),
    ).select(
        "total_customers",
        "churn_rate",
        "avg_monthly_charges",
        "avg_tenure",
        F.col(key).alias(f"{segment}_type"),
        f"{segment}_count",
        f"{segment}_churn_rate",
    )


def band_counts(
    df: DataFrame,
    keys: tuple[str, ...] = ("MonthlyChargesCategory", "TenureCategory"),
) -> DataFrame:
    """Row count per combination of band labels: ``(*keys, customers)``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("customers"))


def to_json_lines(df: DataFrame) -> DataFrame:
    """One JSON object per row in a single ``value`` column (lazy); NULL fields are kept.

    Write it with ``.write.text(path)`` or stream it; nothing is gathered on
    the driver.
    """
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
