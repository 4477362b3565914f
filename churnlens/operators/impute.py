"""Missing-value imputation and null census.

Statistics are scalar subqueries: each runs once, its value is inlined into
the projection as a constant and applied with ``coalesce`` -- no join, nothing
that grows with the input is sent to the tasks. Means come from one plain
aggregate; every median and mode is a subquery of its own, so one that a
report does not use disappears from its plan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.functions.expressions import exact_avg, is_null_count
from churnlens.operators.quantile import exact_medians


def _stat_name(kind: str, col: str) -> str:
    return f"__{kind}__{col}"


def impute(
    df: DataFrame,
    constants: Mapping[str, object] | None = None,
    median_int: Iterable[str] = (),
    mean: Iterable[str] = (),
    mode: Iterable[str] = (),
    median_method: str = "distributed",
    median_accuracy: int = 10_000,
) -> DataFrame:
    """Fill NULLs column by column.

    - ``constants``: fixed value per column.
    - ``median_int``: exact (interpolated) median of the non-NULL values,
      truncated toward zero to an integer, then cast to the column's type.
      ``median_method="distributed"`` works at any cardinality
      (:func:`churnlens.operators.quantile.exact_medians`); ``"exact"`` is
      Spark's own, whose value->count map is merged in one task, for columns
      known to have few distinct values (ages, counts); ``"approx"`` is
      ``percentile_approx`` with ``median_accuracy`` (rank error at most
      rows/accuracy). The choice is explicit, never made silently.
    - ``mean``: unrounded mean of the non-NULL values, as a double; the
      column becomes a double so later steps see the unrounded fill.
    - ``mode``: most frequent non-NULL value, the smallest one on ties.

    A statistic over no non-NULL values is NULL, so those rows stay NULL.
    """
    constants = dict(constants or {})
    median_int, mean, mode = list(median_int), list(mean), list(mode)
    types = {f.name: f.dataType for f in df.schema.fields}  # one JVM round trip

    if median_method not in ("exact", "distributed", "approx"):
        raise ValueError(f"unknown median_method {median_method!r}")

    def median(c: str):
        if median_method == "approx":
            return F.percentile_approx(F.col(c), 0.5, median_accuracy)
        return F.median(c)

    stat = {}
    if mean:
        stat.update(_scalar_fields(df.agg(*[exact_avg(c).alias(_stat_name("mean", c)) for c in mean])))
    if median_method == "distributed" and median_int:
        medians = exact_medians(df, median_int).select(
            *[F.col(c).cast("long").alias(_stat_name("median", c)) for c in median_int]
        )
        stat.update(_scalar_fields(medians))
    elif median_int:
        medians = [median(c).cast("long").alias(_stat_name("median", c)) for c in median_int]
        stat.update(_scalar_fields(df.agg(*medians)))
    for c in mode:
        stat[_stat_name("mode", c)] = most_frequent(df, c).scalar()

    fills = {}
    for c in median_int:
        # Only gaps change: present values keep their type and value.
        fill = stat[_stat_name("median", c)].cast(types[c])
        fills[c] = F.coalesce(F.col(c), fill)
    for c in mean:
        fills[c] = F.coalesce(F.col(c).cast("double"), stat[_stat_name("mean", c)])
    for c in mode:
        fills[c] = F.coalesce(F.col(c), stat[_stat_name("mode", c)])
    for c, value in constants.items():
        fills[c] = F.coalesce(F.col(c), F.lit(value).cast(types[c]))
    return df.withColumns(fills) if fills else df


def _scalar_fields(one_row: DataFrame) -> dict[str, Column]:
    """Columns of a one-row frame as fields of one scalar subquery."""
    packed = one_row.select(F.struct(*one_row.columns)).scalar()
    return {c: packed.getField(c) for c in one_row.columns}


def most_frequent(df: DataFrame, col: str) -> DataFrame:
    """The most frequent non-NULL value, the smallest on ties (no row if none).

    Counts are combined map-side and the best kept per task, so neither many
    distinct values nor one frequent value meets in a single task.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("__n"))
    return counts.orderBy(F.desc("__n"), F.asc(col)).limit(1).select(col)


def null_census(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Per column: NULL count and NULL percentage (rounded to 2), one scan.

    Output ``(column_name, null_count, missing_pct)``, one row per column in
    the input's column order. ``missing_pct`` is NULL for an empty input.
    """
    columns = list(columns or df.columns)
    wide = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[is_null_count(c).alias(c) for c in columns],
    )
    tall = wide.unpivot(["__rows"], columns, "column_name", "null_count")
    return tall.select(
        "column_name",
        F.col("null_count").cast("long").alias("null_count"),
        F.round(
            F.try_divide(F.col("null_count").cast("double"), F.col("__rows")) * F.lit(100), 2
        ).alias("missing_pct"),
    )
