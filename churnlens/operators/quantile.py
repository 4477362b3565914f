"""Exact medians without gathering all distinct values in one task.

``F.median`` is exact but its state is a value->count map merged in a single
task. :func:`exact_medians` gives the same (interpolated) result for columns
of any cardinality, in two scans and without a data-sized shuffle:

1. a quantile sketch brackets the median of every column from both sides;
2. values outside a column's bracket are only counted, those inside (about
   ``2 * MARGIN`` of the rows) are grouped by value, combined map-side, dealt
   into BUCKETS slices of the bracket, and ranked slice by slice with the sums
   of the slices before.

The sketch only decides which values are ranked; should its error bound ever
be missed, the query raises instead of returning another value. Nothing runs
while the plan is built.

For a table that grows, the first scan can be spared: :func:`median_sketches`
summarises some of its rows (a load, a partition) in one small row that is
stored; :func:`sketched_brackets` merges any number of them, and
:func:`exact_medians` takes that as its bracket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Accuracy of the sketch (rank error 1 / ACCURACY), and half the bracket's share of the rows.
ACCURACY = 100_000
MARGIN = 1e-4

#: Slices of a bracket that are ranked apart.
BUCKETS = 4096

#: Size of a stored sketch (some 200 KB a column), and the half width of the bracket taken
#: from merged sketches: three times their rank error, 2.3 / SKETCH_K ** 0.9 with 99 % confidence.
SKETCH_K = 8000
SKETCH_MARGIN = 0.0021


def _ordered(col: str) -> Column:
    """The value as a double, NaN as +infinity (NaN sorts after every number)."""
    x = F.col(col).cast("double")
    return F.when(F.isnan(x), F.lit(float("inf"))).otherwise(x)


def median_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., column, sketch)``: one KLL sketch per column (and group), a small row to store.

    NULLs are not in it; NaN counts as the largest value. A column without values has no row.
    """
    wide = df.groupBy(*by).agg(*[F.kll_sketch_agg_double(_ordered(c), F.lit(SKETCH_K)).alias(f"s{i}") for i, c in enumerate(cols)])
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(cols)]
    rows = wide.select(*by, F.explode(F.array(*cells)).alias("x")).select(*by, "x.column", "x.sketch")
    return rows.filter(F.col("sketch").isNotNull() & (F.kll_sketch_get_n_double("sketch") > 0))


def sketched_brackets(sketches: DataFrame, cols: Sequence[str]) -> Column:
    """The brackets of medians from any number of stored sketches, for :func:`exact_medians`."""

    def merged(c: str) -> Column:
        own = F.kll_merge_agg_double(F.when(F.col("column") == c, F.col("sketch")))
        some = F.count_if(F.col("column") == c) > 0
        at = [F.kll_sketch_get_quantile_double(own, F.lit(0.5 + m).cast("double")) for m in (-SKETCH_MARGIN, SKETCH_MARGIN)]
        return F.when(some, F.array(*at)).alias(c)

    return sketches.agg(F.struct(*[merged(c) for c in cols]).alias("b")).scalar()


def exact_medians(df: DataFrame, cols: Sequence[str], brackets: Column | None = None) -> DataFrame:
    """One-row frame with the interpolated median of each column (as double).

    Column names are kept. NULLs are ignored; NaN counts as the largest
    value; a column without values gives NULL. With ``brackets`` (of
    :func:`sketched_brackets`, over sketches of exactly these rows) ``df`` is
    scanned once; brackets of other rows raise or give the same medians.
    """
    if brackets is None:
        probs = [0.5 - MARGIN, 0.5 + MARGIN]
        brackets = df.agg(
            F.struct(*[F.percentile_approx(_ordered(c), probs, ACCURACY).alias(c) for c in cols]).alias("b")
        ).scalar()
    cells = []
    for i, c in enumerate(cols):
        key, low, high = _ordered(c), brackets[c][0], brackets[c][1]
        width = high - low
        # a bracket of one value, or one that reaches to infinity, is one slice
        slot = F.when(
            (width > 0) & (width < float("inf")),
            F.least(F.floor((key - low) / width * F.lit(BUCKETS)), F.lit(BUCKETS - 1)),
        ).otherwise(0)
        known = low.isNotNull()
        below, above = ~known | (key < low), key > high
        bucket = F.when(below, -1).when(above, BUCKETS).otherwise(slot).cast("int")
        value = F.col(c).cast("double")
        cells.append(
            F.when(
                value.isNotNull(),
                F.struct(F.lit(i).alias("c"), bucket.alias("bucket"), F.when(~below & ~above, value).alias("v")),
            )
        )
    counts = (
        df.select(F.explode(F.array(*cells)).alias("x"))
        .filter("x is not null")
        .groupBy("x.c", "x.bucket", "x.v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    before = Window.partitionBy("c").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    slices = counts.groupBy("c", "bucket").agg(F.sum("n").alias("rows"))
    bases = slices.select(
        "c",
        "bucket",
        F.lit(None).cast("double").alias("v"),
        F.lit(0).cast("long").alias("n"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"),
        F.sum("rows").over(Window.partitionBy("c")).alias("total"),
    )
    # each slice is sorted by a task of its own, after a row with the sum of what lies before it (at most BUCKETS such rows)
    running = Window.partitionBy("c", "bucket").orderBy("v", F.col("base").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    next_ = F.sum("n").over(running) + F.max("base").over(running)
    ranked = counts.unionByName(bases, allowMissingColumns=True).select(
        "c",
        "bucket",
        "v",
        (next_ - F.col("n")).alias("first"),
        next_.alias("next"),
        F.max("total").over(running).alias("total"),
    )

    def at(rank: Column) -> Column:
        hit = (F.col("first") <= rank) & (rank < F.col("next"))
        inside = (F.col("bucket") >= 0) & (F.col("bucket") < BUCKETS)
        missed = F.raise_error(F.lit("median outside its bracket: the sketch missed its error bound"))
        return F.max(F.when(hit, F.when(inside, F.col("v")).otherwise(missed)))

    picked = ranked.groupBy("c").agg(
        ((at(F.floor((F.col("total") - 1) / 2)) + at(F.floor(F.col("total") / 2))) / 2).alias("median")
    )
    return picked.agg(*[F.max(F.when(F.col("c") == i, F.col("median"))).alias(c) for i, c in enumerate(cols)])


def exact_median(df: DataFrame, col: str) -> DataFrame:
    """One-row frame ``(median double)``: the interpolated median of ``col``."""
    return exact_medians(df, [col]).withColumnRenamed(col, "median")
