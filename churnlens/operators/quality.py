"""Data-quality metrics, their history, and checks over that history."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.functions.expressions import (
    exact_avg,
    falsy_to_zero,
    python_timestamp_text,
    rate_percent,
)
from churnlens.schemas import LATEST_METRICS_K, METRIC_NAMES, METRIC_VALUE

log = logging.getLogger(__name__)


def quality_metrics(
    df: DataFrame,
    flag: str = "ChurnFlag",
    charges: str = "MonthlyCharges",
    tenure: str = "Tenure",
    distinct: Sequence[str] = ("ContractType", "Gender"),
    distinct_method: str = "exact",
    rsd: float = 0.01,
) -> DataFrame:
    """The six quality metrics in one row, from one scan.

    ``total_records, churn_rate_percent, avg_monthly_charges,
    avg_tenure_months, distinct_contract_types, distinct_genders``. Rates and
    averages are rounded to 2 decimals and stay NULL on an empty table;
    distinct counts ignore NULL. Exact distinct counts shuffle each distinct
    value once (after per-task de-duplication) -- cheap for categories; for
    columns with huge cardinality ``distinct_method="approx"`` uses a
    HyperLogLog++ sketch per task (relative error ``rsd``) instead. The
    choice is explicit.
    """
    distinct_names = METRIC_NAMES[4:]
    if len(distinct) != len(distinct_names):
        raise ValueError("need one column per distinct-count metric")
    if distinct_method not in ("exact", "approx"):
        raise ValueError(f"unknown distinct_method {distinct_method!r}")

    def n_distinct(c: str):
        if distinct_method == "approx":
            return F.approx_count_distinct(c, rsd)
        return F.count_distinct(c)

    if distinct_method == "exact":
        # Sums and counts add up: group by the counted columns first (categories,
        # so few rows), so that distinct counts do not expand every input row.
        parts = [("flag", flag), ("charges", charges), ("tenure", tenure)]
        groups = df.groupBy(*distinct).agg(
            F.count(F.lit(1)).alias("__rows"),
            *[F.sum(c).alias(f"__{k}_sum") for k, c in parts],
            *[F.count(c).alias(f"__{k}_n") for k, c in parts],
        )

        def average(k: str) -> Column:
            return F.try_divide(F.sum(f"__{k}_sum").cast("double"), F.sum(f"__{k}_n"))

        return groups.agg(
            F.coalesce(F.sum("__rows"), F.lit(0)).alias(METRIC_NAMES[0]),
            F.round(average("flag") * F.lit(100), 2).alias(METRIC_NAMES[1]),
            F.round(average("charges"), 2).alias(METRIC_NAMES[2]),
            F.round(average("tenure"), 2).alias(METRIC_NAMES[3]),
            *[n_distinct(c).alias(n) for c, n in zip(distinct, distinct_names)],
        )
    return df.agg(
        F.count(F.lit(1)).alias(METRIC_NAMES[0]),
        F.round(rate_percent(flag), 2).alias(METRIC_NAMES[1]),
        F.round(exact_avg(charges), 2).alias(METRIC_NAMES[2]),
        F.round(exact_avg(tenure), 2).alias(METRIC_NAMES[3]),
        *[n_distinct(c).alias(n) for c, n in zip(distinct, distinct_names)],
    )


def to_tall(
    wide: DataFrame,
    names: Sequence[str] = METRIC_NAMES,
    run_timestamp: Column | str | None = None,
) -> DataFrame:
    """Wide metric row(s) -> ``(metric_name, metric_value[, run_timestamp])``.

    Values become ``decimal(18,2)``; a NULL or zero metric is stored as 0.
    ``run_timestamp`` is either a column expression (one value for the whole
    run, e.g. ``localtimestamp()``) or the name of a column of ``wide`` that
    identifies the run of each wide row.
    """
    ids = [run_timestamp] if isinstance(run_timestamp, str) else []
    typed = wide.select(
        *ids, *[falsy_to_zero(F.col(n)).cast(METRIC_VALUE).alias(n) for n in names]
    )
    tall = typed.unpivot(ids, list(names), "metric_name", "metric_value")
    if isinstance(run_timestamp, Column):
        tall = tall.withColumn("run_timestamp", run_timestamp)
    elif isinstance(run_timestamp, str):
        tall = tall.select(
            "metric_name", "metric_value", F.col(run_timestamp).alias("run_timestamp")
        )
    return tall


def metric_ordinal(name_col: str = "metric_name", names: Sequence[str] = METRIC_NAMES) -> Column:
    """Position of a metric in the order metrics are produced (unknown: -1)."""
    expr = F.lit(-1)
    for i, n in reversed(list(enumerate(names))):
        expr = F.when(F.col(name_col) == F.lit(n), F.lit(i)).otherwise(expr)
    return expr


def latest_metrics(
    history: DataFrame,
    k: int = LATEST_METRICS_K,
    ts_col: str = "run_timestamp",
    tiebreak: Sequence[Column] | None = None,
) -> DataFrame:
    """The ``k`` newest metric rows: ``(metric_name, metric_value, timestamp)``.

    Newest first; rows of one run share a timestamp, so ties go to the metric
    produced last (then name, then value) to keep the order total. The value
    is a double with NULL/0 reported as 0; the timestamp is text written the
    way Python prints a datetime. Planned as a top-k: every task keeps only
    its own ``k`` best rows before one final merge.
    """
    if tiebreak is None:
        tiebreak = [
            metric_ordinal().desc(),
            F.col("metric_name").desc_nulls_last(),
            F.col("metric_value").desc_nulls_last(),
        ]
    top = history.orderBy(F.col(ts_col).desc_nulls_last(), *tiebreak).limit(k)
    return top.select(
        "metric_name",
        falsy_to_zero(F.col("metric_value").cast("double")).alias("metric_value"),
        python_timestamp_text(ts_col).alias("timestamp"),
    )


def last_not_null(
    history: DataFrame,
    key: str,
    value: str,
    order: Sequence[str],
) -> DataFrame:
    """Per ``key``: the newest non-NULL ``value`` and the ``order`` of that row.

    ``order`` columns (newest = largest, compared left to right) must make
    the order total within a key. Uses ``max_by`` over a struct that is NULL
    for NULL values, so a NULL in the newest row does not hide older values.
    Partial aggregation: a key holding most rows is reduced in every task
    before the shuffle.
    """
    ordering = F.when(F.col(value).isNotNull(), F.struct(*[F.col(c) for c in order]))
    picked = history.groupBy(key).agg(
        F.max_by(F.col(value), ordering).alias(f"last_{value}"),
        F.max(ordering).alias("__at"),
    )
    return picked.select(
        key, f"last_{value}", *[F.col("__at").getField(c).alias(f"last_{c}") for c in order]
    )


def reconcile(staging: DataFrame, production: DataFrame) -> DataFrame:
    """One row ``(staging_rows, production_rows, matches)`` from two counts."""
    s = staging.agg(F.count(F.lit(1)).alias("staging_rows"))
    p = production.agg(F.count(F.lit(1))).scalar()  # one value, inlined
    return s.select("staging_rows", p.alias("production_rows")).withColumn(
        "matches", F.col("staging_rows") == F.col("production_rows")
    )


def reconcile_counts(staging_rows: int, production_rows: int) -> bool:
    """Warn (and return False) when a transform changed the row count."""
    if staging_rows != production_rows:
        log.warning(
            "Row count mismatch: staging=%s, production=%s", staging_rows, production_rows
        )
        return False
    return True


def metric_trend(
    history: DataFrame,
    names: Sequence[str],
    ts_col: str = "run_timestamp",
) -> DataFrame:
    """One row per run: each metric's value and its change since the run before.

    Changes are computed per metric over the tall history (one window
    partition per metric, as long as the number of runs), then pivoted on
    the fixed list of ``names``.
    """
    w = Window.partitionBy("metric_name").orderBy(ts_col)
    with_delta = history.where(F.col("metric_name").isin(list(names))).withColumn(
        "delta", F.col("metric_value") - F.lag("metric_value").over(w)
    )
    return (
        with_delta.groupBy(ts_col)
        .pivot("metric_name", list(names))
        .agg(F.max("metric_value").alias("value"), F.max("delta").alias("delta"))
    )


def metric_alerts(
    history: DataFrame,
    volume_metric: str = "total_records",
    sigmas: float = 2.0,
    max_change_pct: float = 10.0,
    ts_col: str = "run_timestamp",
) -> DataFrame:
    """Flag each run's metrics against that metric's earlier runs.

    - ``sigma_alert``: the value lies more than ``sigmas`` sample standard
      deviations from the mean of all earlier runs (NULL with fewer than two
      earlier runs).
    - ``volume_alert``: for ``volume_metric`` only, the value moved more than
      ``max_change_pct`` percent from the run just before (NULL otherwise).

    One window partition per metric, as long as the number of runs.
    """
    w = Window.partitionBy("metric_name").orderBy(ts_col)
    prior = w.rowsBetween(Window.unboundedPreceding, -1)
    v = F.col("metric_value").cast("double")
    out = history.select(
        "metric_name",
        ts_col,
        v.alias("metric_value"),
        F.avg(v).over(prior).alias("prior_mean"),
        F.stddev_samp(v).over(prior).alias("prior_std"),
        F.lag(v).over(w).alias("prev_value"),
    )
    pct = F.try_divide(F.col("metric_value") - F.col("prev_value"), F.abs(F.col("prev_value"))) * 100
    return out.select(
        "metric_name",
        ts_col,
        "metric_value",
        "prior_mean",
        "prior_std",
        (F.abs(F.col("metric_value") - F.col("prior_mean")) > F.lit(sigmas) * F.col("prior_std"))
        .alias("sigma_alert"),
        F.when(F.col("metric_name") == F.lit(volume_metric), pct).alias("pct_change"),
        F.when(F.col("metric_name") == F.lit(volume_metric), F.abs(pct) > F.lit(max_change_pct))
        .alias("volume_alert"),
    )
