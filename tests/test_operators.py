"""Operator-level tests on small hand-checked frames."""

from __future__ import annotations

import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from churnlens.functions.expressions import (
    band_left_closed,
    bin_right_closed,
    flag_equals,
    na_to_null,
    python_timestamp_text,
)
from churnlens.operators import (
    anonymize_hash,
    anonymize_uuid,
    conform,
    derive_features,
    display_round,
    impute,
    null_census,
    rate_band,
    select_field,
    table_band,
)
from churnlens.schemas import CHARGE_EDGES, CHARGE_LABELS, NA_TOKENS, TENURE_EDGES, TENURE_LABELS


def test_flag_equals_is_exact_and_null_safe(spark):
    df = spark.createDataFrame([("Yes",), ("yes",), ("No",), (None,)], "Churn string")
    got = [r[0] for r in df.select(flag_equals("Churn", "Yes")).collect()]
    assert got == [1, 0, 0, 0]


@pytest.mark.parametrize(
    "value,label",
    [(0.0, "nan"), (-3.0, "nan"), (0.01, "Low"), (50.0, "Low"), (50.01, "Medium"),
     (100.0, "Medium"), (100.01, "High"), (1e9, "High"), (None, "nan")],
)
def test_charge_bins_are_right_closed(spark, value, label):
    df = spark.createDataFrame([(value,)], "x double")
    got = df.select(bin_right_closed("x", CHARGE_EDGES, CHARGE_LABELS)).first()[0]
    assert got == label


@pytest.mark.parametrize(
    "value,label", [(0, "nan"), (1, "New"), (12, "New"), (13, "Medium"), (36, "Medium"), (37, "Long")]
)
def test_tenure_bins(spark, value, label):
    df = spark.createDataFrame([(value,)], "x int")
    assert df.select(bin_right_closed("x", TENURE_EDGES, TENURE_LABELS)).first()[0] == label


def test_bins_with_finite_last_edge_and_custom_outside(spark):
    df = spark.createDataFrame([(5,), (10,), (11,)], "x int")
    col = bin_right_closed("x", (0, 5, 10), ("a", "b"), outside="other")
    assert [r[0] for r in df.select(col).collect()] == ["a", "b", "other"]


@pytest.mark.parametrize(
    "rate,band", [(0.0, "green"), (49.99, "green"), (50.0, "yellow"), (79.99, "yellow"),
                  (80.0, "red"), (100.0, "red"), (None, "green")]
)
def test_rate_bands_left_closed(spark, rate, band):
    df = spark.createDataFrame([(rate,)], "churn_rate double")
    assert rate_band(df).first()["rate_band"] == band


def test_table_band(spark):
    df = spark.createDataFrame([(79.9,), (80.0,)], "churn_rate double")
    assert [r["table_band"] for r in table_band(df).collect()] == ["green", "red"]


def test_display_round_and_field_select(spark):
    df = spark.createDataFrame([(25.24, 40.0)], "avg_tenure double, churn_rate double")
    assert display_round(df, "avg_tenure", 1).first()["avg_tenure"] == 25.2
    assert select_field(df, "^churn_rate$").columns == ["churn_rate"]


def test_band_left_closed_without_bands(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    assert df.select(band_left_closed("x", [], "base")).first()[0] == "base"


def test_na_tokens(spark):
    rows = [(t,) for t in NA_TOKENS] + [("Male",), (" NA",), ("0",)]
    df = spark.createDataFrame(rows, "v string")
    got = [r[0] for r in df.select(na_to_null("v")).collect()]
    assert got[: len(NA_TOKENS)] == [None] * len(NA_TOKENS)
    assert got[len(NA_TOKENS):] == ["Male", " NA", "0"]


def test_conform_orders_casts_and_rounds(spark):
    from pyspark.sql import types as T

    schema = T.StructType(
        [T.StructField("b", T.IntegerType()), T.StructField("a", T.DecimalType(10, 2))]
    )
    df = spark.createDataFrame(
        [("2.5", 1.005, "x"), ("3.5", 2.0, "y"), ("25.0", 86.254, "z")], "b string, a double, c string"
    )
    out = conform(df, schema)
    assert out.columns == ["b", "a"]
    assert [r["b"] for r in out.collect()] == [2, 4, 25]  # half to even
    assert out.collect()[2]["a"] == Decimal("86.25")
    with pytest.raises(ValueError):
        conform(df.drop("a"), schema)


def test_impute_median_is_truncated_and_mean_unrounded(spark):
    df = spark.createDataFrame(
        [(25, 50.0), (None, None), (45, 100.0), (30, 75.0), (55, 120.0)],
        "Age int, MonthlyCharges double",
    ).withColumn("MonthlyCharges", F.col("MonthlyCharges").cast("decimal(10,2)"))
    out = impute(df, median_int=["Age"], mean=["MonthlyCharges"]).collect()
    assert out[1]["Age"] == 37  # median 37.5 truncated
    assert out[1]["MonthlyCharges"] == pytest.approx(86.25)
    assert isinstance(out[1]["MonthlyCharges"], float)


def test_impute_median_keeps_present_values(spark):
    df = spark.createDataFrame([(1.5,), (None,), (4.25,), (10.0,)], "x double")
    got = [r["x"] for r in impute(df, median_int=["x"]).collect()]
    assert got == [1.5, 4.0, 4.25, 10.0]  # only the gap gets int(4.25)


def test_impute_all_null_keeps_rows_and_nulls(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "Age int, g string")
    out = impute(df, constants={"g": "Unknown"}, median_int=["Age"]).collect()
    assert [(r["Age"], r["g"]) for r in out] == [(None, "Unknown"), (None, "Unknown")]


def test_impute_mode_breaks_ties_by_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "x string")
    out = impute(df, mode=["x"]).collect()
    assert out[4]["x"] == "a"


def test_impute_empty_input(spark):
    df = spark.createDataFrame([], "Age int, MonthlyCharges decimal(10,2)")
    assert impute(df, median_int=["Age"], mean=["MonthlyCharges"]).count() == 0


def test_impute_plan_is_a_scalar_subquery_without_join(spark):
    df = spark.range(100).select(
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id")).alias("x"),
        F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") * 0.5).alias("y"),
    )
    out = impute(df, median_int=["x"], mean=["y"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "Join" not in plan
    assert re.findall(r"subquery#(\d+)", final)
    only_mean = out.select("y")
    only_mean.collect()
    assert "percentile" not in only_mean._jdf.queryExecution().executedPlan().toString()  # unused, so not computed


def test_null_census(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x"), (4, "y")], "a int, b string")
    got = {r["column_name"]: (r["null_count"], r["missing_pct"]) for r in null_census(df).collect()}
    assert got == {"a": (1, 25.0), "b": (2, 50.0)}
    assert sum(v[0] for v in got.values()) == 3


def test_anonymize_uuid_unique_shape(spark):
    df = spark.range(1000).withColumnRenamed("id", "CustomerID")
    out = anonymize_uuid(df, "CustomerID", "AnonymizedCustomerID")
    assert "CustomerID" not in out.columns
    ids = [r[0] for r in out.collect()]
    assert len(set(ids)) == 1000
    pattern = re.compile(r"^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")
    assert all(pattern.match(i) for i in ids)


def test_anonymize_hash_is_deterministic(spark):
    import hashlib

    df = spark.createDataFrame([(7,), (8,)], "id long")
    a = [r[0] for r in anonymize_hash(df, "id", "anon", "s").collect()]
    b = [r[0] for r in anonymize_hash(df, "id", "anon", "s").collect()]
    assert a == b
    assert a[0] == hashlib.sha256(b"s|7").hexdigest()
    assert anonymize_hash(df, "id", "anon", "other").first()[0] != a[0]


def test_derive_features(spark):
    df = spark.createDataFrame(
        [("Yes", 86.25, 0), ("No", 50.0, 12), (None, 120.0, 37)],
        "Churn string, MonthlyCharges double, Tenure int",
    )
    got = [tuple(r) for r in derive_features(df).select(
        "ChurnFlag", "MonthlyChargesCategory", "TenureCategory").collect()]
    assert got == [(1, "Medium", "nan"), (0, "Low", "New"), (0, "High", "Long")]


def test_python_timestamp_text(spark):
    import datetime as dt

    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 2, 3, 4, 5),), (dt.datetime(2024, 1, 2, 3, 4, 5, 120),)],
        "ts timestamp_ntz",
    )
    got = [r[0] for r in df.select(python_timestamp_text("ts")).collect()]
    assert got == [str(dt.datetime(2024, 1, 2, 3, 4, 5)), str(dt.datetime(2024, 1, 2, 3, 4, 5, 120))]


def test_impute_approx_median_option(spark):
    df = spark.range(1, 1002).select(
        F.when(F.col("id") == 1001, None).otherwise(F.col("id")).alias("x")
    )
    exact = impute(df, median_int=["x"]).where(F.col("x") == 500).count()
    assert exact == 2  # the filled row got the truncated median 500.5 -> 500
    approx = impute(df, median_int=["x"], median_method="approx").collect()[-1]["x"]
    assert abs(approx - 500) <= 1
    distributed = impute(df, median_int=["x"], median_method="distributed").collect()[-1]["x"]
    assert distributed == 500


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 20001])
def test_exact_median_matches_builtin(spark, n):
    from churnlens.operators.quantile import exact_median

    # Many distinct values plus one value holding a third of the rows.
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(123456789)).otherwise((F.col("id") * 7919) % 100003).alias("x")
    )
    want = df.agg(F.median("x")).first()[0]
    got = exact_median(df, "x").first()[0]
    assert got == want


def test_exact_median_empty_and_decimal(spark):
    from churnlens.operators.quantile import exact_median

    empty = spark.createDataFrame([], "x int")
    assert exact_median(empty, "x").first()[0] is None
    dec = spark.createDataFrame([(1.25,), (2.5,), (None,), (10.0,), (3.75,)], "x double").withColumn(
        "x", F.col("x").cast("decimal(10,2)"))
    assert exact_median(dec, "x").first()[0] == 3.125


def test_exact_medians_with_nan_and_infinities(spark):
    from churnlens.operators.quantile import exact_medians

    x = F.when(F.col("id") % 10 == 0, F.lit(float("nan"))).when(F.col("id") % 10 == 1, F.lit(float("-inf")))
    df = spark.range(1000).select(
        x.otherwise(F.col("id").cast("double")).alias("x"),
        F.when(F.col("id") % 2 == 0, F.lit(float("nan"))).otherwise(F.lit(1.0)).alias("y"),
    )
    want = df.agg(F.median("x"), F.median("y")).first()
    got = exact_medians(df, ["x", "y"]).first()
    assert got[0] == want[0] and str(got[1]) == str(want[1]) == "nan"


def test_anonymize_hash_keeps_a_missing_id_missing(spark):
    rows = anonymize_hash(spark.createDataFrame([(1,), (None,)], "id int"), "id", "h", "salt").collect()
    assert rows[0]["h"] and rows[1]["h"] is None


def test_utc_now_ignores_the_session_zone(spark):
    import datetime as dt

    from churnlens.functions.expressions import utc_now

    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        now = spark.range(1).select(utc_now().alias("t")).first()["t"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert abs((now - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).total_seconds()) < 60
