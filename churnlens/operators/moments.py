"""Alerts over a growing metric history, from the new runs and one state row per metric.

A metric's state holds the number of its values, their mean and the sum of
squared deviations (m2), and the newest value. Two such states merge by the
parallel variance formula, so judging a run needs its own rows and the state
rows, however long the history is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: A value counts as beyond the limit when it is so by more than this share of itself: sums in
#: another order differ in the last digits, and a value right at the limit is not beyond it.
LIMIT_NOISE = 1e-9


def _values(rows: DataFrame, ts_col: str) -> DataFrame:
    return rows.select("metric_name", F.col(ts_col).alias("ts"), F.col("metric_value").cast("double").alias("v"))


def metric_state(rows: DataFrame, ts_col: str = "run_timestamp") -> DataFrame:
    """``(metric_name, n, mean, m2, last_value, last_timestamp)`` of some runs' rows.

    NULL values count for ``last_value`` (they are the newest run's value)
    but not for the moments. One state row per metric, combined map-side.
    """
    v = F.col("v")
    return (
        _values(rows, ts_col)
        .groupBy("metric_name")
        .agg(
            F.count(v).alias("n"),
            F.avg(v).alias("mean"),
            (F.var_pop(v) * F.count(v)).alias("m2"),
            F.max_by(v, "ts").alias("last_value"),
            F.max("ts").alias("last_timestamp"),
        )
    )


def merged_state(states: DataFrame) -> DataFrame:
    """One state per metric from any number of them, in any order.

    With the common mean M = sum(n * mean) / sum(n), m2 is the sum of each
    part's m2 and of n * (mean - M)^2: no cancellation of large squares.
    """
    n, mean = F.col("n"), F.col("mean")
    by_metric = Window.partitionBy("metric_name")
    whole = F.try_divide(F.sum(n * mean).over(by_metric), F.sum(F.when(mean.isNotNull(), n)).over(by_metric))
    shifted = states.withColumn("__mean", whole)
    return shifted.groupBy("metric_name").agg(
        F.sum("n").alias("n"),
        F.max("__mean").alias("mean"),
        F.sum(F.col("m2") + n * F.pow(mean - F.col("__mean"), 2)).alias("m2"),
        F.max_by("last_value", "last_timestamp").alias("last_value"),
        F.max("last_timestamp").alias("last_timestamp"),
    )


def advanced_state(state: DataFrame, rows: DataFrame, ts_col: str = "run_timestamp") -> DataFrame:
    """The state after some more runs."""
    return merged_state(state.unionByName(metric_state(rows, ts_col)))


def incremental_alerts(
    state: DataFrame,
    rows: DataFrame,
    volume_metric: str = "total_records",
    sigmas: float = 2.0,
    max_change_pct: float = 10.0,
    ts_col: str = "run_timestamp",
) -> DataFrame:
    """:func:`churnlens.operators.quality.metric_alerts` of new runs after ``state``.

    Same columns and rules (but a value within LIMIT_NOISE of the limit raises
    no sigma alert, however the sums round); ``rows`` are the new runs' metric rows, all later
    than the state's (a run that arrives late is judged by what came before
    its load, not by its date). The state is shifted to its own mean, so the
    running sums over the new runs stay small. One window partition per
    metric, as long as the number of new runs.
    """
    known = state.select(
        F.col("metric_name").alias("__name"),
        F.coalesce("n", F.lit(0)).alias("n0"),
        F.col("mean").alias("mean0"),
        F.coalesce("m2", F.lit(0.0)).alias("m20"),
        "last_value",
    )
    fresh = _values(rows, ts_col).join(known, F.col("metric_name").eqNullSafe(F.col("__name")), "left")
    w = Window.partitionBy("metric_name").orderBy("ts")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    v = F.col("v")
    # without a state the first value is the shift
    all_new = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    mean0 = F.coalesce("mean0", F.first(v, ignorenulls=True).over(all_new))
    d = v - F.col("shift")

    def running(x: Column) -> Column:
        return F.coalesce(F.sum(x).over(before), F.lit(0.0))

    merged = fresh.withColumn("shift", mean0).select(
        "metric_name",
        "ts",
        "v",
        "shift",
        (F.coalesce("n0", F.lit(0)) + F.count(v).over(before)).alias("n"),
        running(d).alias("a"),
        (F.coalesce("m20", F.lit(0.0)) + running(d * d)).alias("b"),
        F.when(F.row_number().over(w) == 1, F.col("last_value")).otherwise(F.lag("v").over(w)).alias("prev"),
    )
    n = F.col("n")
    m2 = F.greatest(F.col("b") - F.col("a") * F.col("a") / F.nullif(n, F.lit(0)), F.lit(0.0))
    judged = merged.select(
        "metric_name",
        F.col("ts").alias(ts_col),
        v.alias("metric_value"),
        F.when(n > 0, F.col("shift") + F.col("a") / n).alias("prior_mean"),
        F.when(n > 1, F.sqrt(m2 / (n - 1))).alias("prior_std"),
        F.when(
            F.col("metric_name") == volume_metric, F.try_divide(v - F.col("prev"), F.abs("prev")) * 100
        ).alias("pct_change"),
    )
    beyond = F.abs(F.col("metric_value") - F.col("prior_mean")) - F.lit(sigmas) * F.col("prior_std")
    sigma = beyond > F.lit(LIMIT_NOISE) * F.abs("metric_value")
    return judged.select(
        "metric_name",
        ts_col,
        "metric_value",
        "prior_mean",
        "prior_std",
        sigma.alias("sigma_alert"),
        "pct_change",
        F.when(F.col("metric_name") == volume_metric, F.abs("pct_change") > F.lit(max_change_pct)).alias("volume_alert"),
    )
