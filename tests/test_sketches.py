"""Medians bracketed by stored sketches, distinct counts of loads, the mode at any cardinality."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from churnlens.operators import most_frequent, quality_metrics, sketches
from churnlens.operators.quantile import exact_medians, median_sketches, sketched_brackets
from churnlens.operators.sketches import DISTINCT_ERROR, distinct_sketches, most_frequent_value, sketched_distinct


def medians(df, cols, brackets=None):
    return tuple(exact_medians(df, cols, brackets).first())


def frame(spark, values, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} double")


CASES = {
    "uniform": lambda r: [r.random() for _ in range(4001)],
    "few values": lambda r: [float(r.randrange(3)) for _ in range(4000)],
    "one value": lambda r: [7.0] * 100,
    "a spike inside": lambda r: [r.random() for _ in range(1000)] + [0.5] * 3000,
    "wide range": lambda r: [10.0 ** r.uniform(-300, 300) * r.choice([-1, 1]) for _ in range(2000)],
    "infinities": lambda r: [float("inf")] * 30 + [float("-inf")] * 30 + [r.gauss(0, 1) for _ in range(41)],
    "mostly infinite": lambda r: [float("inf")] * 60 + [1.0] * 30,
    "nan counts largest": lambda r: [float("nan")] * 49 + [r.random() for _ in range(50)],
    "nulls": lambda r: [None] * 50 + [1.0, 2.0],
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_medians_by_slices(spark, case):
    df = frame(spark, CASES[case](random.Random(1))).repartition(3).cache()
    want = df.agg(F.median("x")).first()[0]
    assert medians(df, ["x"])[0] == want
    parts = [df.filter(F.pmod(F.hash("x"), F.lit(3)) == k) for k in range(3)]
    stored = median_sketches(parts[0], ["x"])
    for p in parts[1:]:
        stored = stored.unionByName(median_sketches(p, ["x"]))
    assert medians(df, ["x"], sketched_brackets(stored, ["x"]))[0] == want


def test_medians_of_several_columns_and_none(spark):
    df = spark.createDataFrame([(1, None), (5, None), (9, None)], "a int, b double")
    assert medians(df, ["a", "b"]) == (5.0, None)
    stored = median_sketches(df, ["a", "b"])
    assert [r["column"] for r in stored.collect()] == ["a"]
    assert medians(df, ["a", "b"], sketched_brackets(stored, ["a", "b"])) == (5.0, None)


def test_sketches_by_partition_name_their_group(spark):
    df = spark.range(3000).selectExpr("id % 3 AS load", "CAST(id AS double) AS x")
    stored = median_sketches(df, ["x"], ["load"])
    assert sorted(r["load"] for r in stored.collect()) == [0, 1, 2]
    assert medians(df, ["x"], sketched_brackets(stored, ["x"])) == (1499.5,)


def test_brackets_of_other_rows_raise(spark):
    wrong = sketched_brackets(median_sketches(spark.range(1000).selectExpr("CAST(id AS double) AS x"), ["x"]), ["x"])
    with pytest.raises(Exception, match="outside its bracket"):
        medians(spark.range(5000, 9000).selectExpr("CAST(id AS double) AS x"), ["x"], wrong)


def test_distinct_counts_of_loads(spark):
    df = spark.range(60_000).selectExpr("id % 4 AS load", "id % 20011 AS a", "if(id % 2 = 0, 'x', null) AS b")
    stored = distinct_sketches(df, ["a", "b"], ["load"])
    assert stored.count() == 8
    got = {r["column"]: r["n_distinct"] for r in sketched_distinct(stored).collect()}
    assert abs(got["a"] - 20011) <= 3 * DISTINCT_ERROR * 20011 and got["b"] == 1
    one = {r["load"]: r["n_distinct"] for r in sketched_distinct(stored.filter("column = 'a'"), ["load"]).collect()}
    exact = {r["load"]: r["n"] for r in df.groupBy("load").agg(F.count_distinct("a").alias("n")).collect()}
    assert one.keys() == exact.keys() and all(abs(one[k] - exact[k]) <= 3 * DISTINCT_ERROR * exact[k] for k in one)
    assert quality_metrics.__name__  # the exact counts stay where they were


def skewed(spark, n, distinct, hot):
    return spark.range(n).selectExpr(f"if(id % 100 < {hot}, -5, id % {distinct}) AS x")


@pytest.mark.parametrize("distinct, hot", [(10, 0), (5000, 0), (5000, 30), (40_000, 30), (40_000, 0)])
def test_mode(spark, distinct, hot):
    df = skewed(spark, 50_000, distinct, hot)
    assert most_frequent_value(df, "x").collect() == most_frequent(df, "x").collect()


def test_mode_without_a_full_count(spark, monkeypatch):
    def never(*_):
        raise AssertionError("all values are counted")

    monkeypatch.setattr(sketches, "most_frequent", never)
    assert most_frequent_value(skewed(spark, 50_000, 40_000, 30), "x").first()["x"] == -5  # stands out
    assert most_frequent_value(skewed(spark, 50_000, 2000, 0), "x").first()["x"] == 0  # every value has a counter
    with pytest.raises(AssertionError):
        most_frequent_value(skewed(spark, 50_000, 40_000, 0), "x")


def test_mode_of_texts_ties_and_nulls(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), (None,), (None,), ("a",), ("b",)], "`odd name` string")
    assert most_frequent_value(df, "odd name").collect()[0][0] == "a"
    assert most_frequent_value(df.filter("`odd name` is null"), "odd name").collect() == []
    assert most_frequent_value(df.limit(0), "odd name").collect() == []
