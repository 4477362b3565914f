"""Distinct counts and the mode of tables that grow or have many distinct values.

Distinct counts: one HyperLogLog sketch per load and column is stored (a few
KB); the count over any set of loads is the estimate of their union, so a
refresh reads new loads only. The exact counts stay available in
:mod:`churnlens.operators.quality`.

Mode: frequent-item summaries (Misra-Gries counters, merged across tasks) pick
candidates, which alone are then counted exactly; where the summary's bound
cannot rule the other values out, all values are counted.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.functions.expressions import sql_ident
from churnlens.operators.impute import most_frequent

#: log2 of a sketch's registers, and its relative standard error.
REGISTERS = 14
DISTINCT_ERROR = 1.04 / math.sqrt(1 << REGISTERS)

#: Counters of a frequent-item summary. Its counts are off by at most 3.5 / 16384 of the rows, and
#: it names every value with over twice that (COUNTER_SHARE); fewer than CANDIDATES have half as many.
COUNTERS = 8192
COUNTER_SHARE = 3.5 / 8192
CANDIDATES = 5000


def distinct_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., column, sketch)``: one HyperLogLog sketch per column (and group). NULLs do not count."""
    wide = df.groupBy(*by).agg(
        *[F.hll_sketch_agg(F.col(sql_ident(c)).cast("string"), F.lit(REGISTERS)).alias(f"s{i}") for i, c in enumerate(cols)]
    )
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(cols)]
    return wide.select(*by, F.explode(F.array(*cells)).alias("x")).select(*by, "x.column", "x.sketch")


def sketched_distinct(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., column, n_distinct)`` over the union of stored sketches.

    The relative standard error is DISTINCT_ERROR (0.8 %): within three times
    that, 2.4 %, in all but a few of a thousand counts.
    """
    union = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return sketches.groupBy(*by, "column").agg(union.alias("n_distinct"))


def candidates(df: DataFrame, col: str) -> DataFrame:
    """Rows (value) that hold every value with more than COUNTER_SHARE of the non-NULL rows."""
    values = df.select(F.col(sql_ident(col)).alias("value")).where("value is not null")
    top = values.agg(F.expr(f"approx_top_k(value, {CANDIDATES}, {COUNTERS})").alias("top"))
    return top.select(F.explode("top").alias("x")).select(F.col("x.item").alias("value"))


def most_frequent_value(df: DataFrame, col: str) -> DataFrame:
    """The most frequent non-NULL value, the smallest on ties (no row if there is none).

    The same as :func:`churnlens.operators.impute.most_frequent`, without
    shuffling every distinct value where the most frequent one stands out: at
    most CANDIDATES values are counted, per task, before the shuffle. Runs the
    summary and the candidates' count when called, as they decide the plan.
    """
    found = [r["value"] for r in candidates(df, col).collect()]  # at most CANDIDATES
    if not found:
        return most_frequent(df, col)
    values = df.select(F.col(sql_ident(col)).alias("value")).where("value is not null")
    named = F.col("value").isin(found)
    counts = values.agg(F.count(F.lit(1)).alias("rows"), F.count_if(named).alias("among")).first()
    best = values.where(named).groupBy("value").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc("value")).first()
    if counts["among"] < counts["rows"] and best["n"] <= counts["rows"] * COUNTER_SHARE:
        return most_frequent(df, col)
    return df.sparkSession.createDataFrame([(best["value"],)], df.select(sql_ident(col)).schema)
