"""Report and quality queries against hand-computed values (fixture F2)."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from churnlens.operators import (
    last_not_null,
    latest_metrics,
    metric_alerts,
    metric_trend,
    quality_metrics,
    reconcile,
    segment_profile,
    segment_rate,
    summary,
    to_json_lines,
    to_tall,
)
from churnlens.schemas import METRIC_NAMES

F2 = [
    ("One-Year", 30, 64.1, 0, "Male"),
    ("Month-to-Month", 3, 29.9, 1, "Female"),
    ("Two-Year", 60, 101.0, 0, "Female"),
    ("Month-to-Month", 9, 55.1, 1, "Male"),
    ("One-Year", 18, 89.9, 1, "Female"),
    ("Two-Year", 70, 80.0, 0, "Male"),
]
F2_SCHEMA = "ContractType string, Tenure int, MonthlyCharges decimal(10,2), ChurnFlag int, Gender string"


@pytest.fixture
def f2(spark):
    from decimal import Decimal

    rows = [(c, t, Decimal(str(m)), f, g) for c, t, m, f, g in F2]
    return spark.createDataFrame(rows, F2_SCHEMA)


def test_summary(f2):
    row = summary(f2).first()
    assert tuple(row) == (6, 50.0, 70.0, 31.67)


def test_summary_empty_table_reports_zero(spark):
    row = summary(spark.createDataFrame([], F2_SCHEMA)).first()
    assert tuple(row) == (0, 0.0, 0.0, 0.0)


def test_churn_by_contract_ordered_riskiest_first(f2):
    got = [tuple(r) for r in segment_rate(f2, "ContractType").collect()]
    assert got == [("Month-to-Month", 2, 100.0), ("One-Year", 2, 50.0), ("Two-Year", 2, 0.0)]
    assert segment_rate(f2, "ContractType").columns == ["contract_type", "count", "churn_rate"]


def test_segment_rate_null_key_is_a_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 0), ("a", 1)], "ContractType string, ChurnFlag int")
    got = {r[0]: (r[1], r[2]) for r in segment_rate(df).collect()}
    assert got == {None: (2, 50.0), "a": (1, 100.0)}


def test_segment_profile_fields(f2):
    rows = {r["contract_type"]: r.asDict() for r in segment_profile(f2).collect()}
    m2m = rows["Month-to-Month"]
    assert m2m["total_customers"] == m2m["contract_count"] == 2
    assert m2m["churn_rate"] == m2m["contract_churn_rate"] == 100.0
    assert m2m["avg_monthly_charges"] == 42.5 and m2m["avg_tenure"] == 6.0


def test_flag_null_handling_differs_between_reports(spark):
    df = spark.createDataFrame(
        [("A", 1), ("A", None), ("A", 0), ("A", 0)], "ContractType string, ChurnFlag int"
    )
    df = df.withColumn("MonthlyCharges", F.lit(1).cast("decimal(10,2)")).withColumn("Tenure", F.lit(1))
    # Rounded rate leaves the NULL out (1 of 3); the profile counts it as 0 (1 of 4).
    assert segment_rate(df).first()["churn_rate"] == 33.33
    assert segment_profile(df).first()["churn_rate"] == 25.0


def test_quality_metrics_wide_and_tall(f2, spark):
    wide = quality_metrics(f2)
    assert wide.columns == list(METRIC_NAMES)
    assert tuple(wide.first()) == (6, 50.0, 70.0, 31.67, 3, 2)
    tall = to_tall(wide, run_timestamp=F.localtimestamp())
    rows = tall.collect()
    assert [r["metric_name"] for r in rows] == list(METRIC_NAMES)
    assert len({r["run_timestamp"] for r in rows}) == 1
    assert str(rows[1]["metric_value"]) == "50.00"


def test_quality_metrics_empty_keep_null_tall_zero(spark):
    wide = quality_metrics(spark.createDataFrame([], F2_SCHEMA))
    assert tuple(wide.first()) == (0, None, None, None, 0, 0)
    assert {float(r["metric_value"]) for r in to_tall(wide).collect()} == {0.0}


def _history(spark):
    t1, t2 = dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 2, 10)
    rows = [(n, float(i + 1), t1) for i, n in enumerate(METRIC_NAMES)]
    rows += [(n, float(i + 10), t2) for i, n in enumerate(METRIC_NAMES)]
    return spark.createDataFrame(rows, "metric_name string, metric_value double, run_timestamp timestamp_ntz")


def test_latest_metrics_newest_run_first_last_metric_first(spark):
    got = latest_metrics(_history(spark)).collect()
    assert len(got) == 10
    assert [r["metric_name"] for r in got[:6]] == list(reversed(METRIC_NAMES))
    assert got[0]["timestamp"] == "2024-01-02 10:00:00"
    assert [r["metric_name"] for r in got[6:]] == list(reversed(METRIC_NAMES))[:4]


def test_latest_metrics_zero_for_null(spark):
    df = spark.createDataFrame(
        [("x", None, dt.datetime(2024, 1, 1))],
        "metric_name string, metric_value double, run_timestamp timestamp_ntz",
    )
    assert latest_metrics(df).first()["metric_value"] == 0.0


def test_last_not_null_skips_newest_null(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 1, 1), ("a", 2.0, 2, 2), ("a", None, 3, 3), ("b", None, 1, 4)],
        "k string, v double, ts int, id int",
    )
    got = {r["k"]: (r["last_v"], r["last_ts"]) for r in last_not_null(df, "k", "v", ["ts", "id"]).collect()}
    assert got == {"a": (2.0, 2), "b": (None, None)}


def test_reconcile(spark):
    a, b = spark.range(5), spark.range(4)
    assert tuple(reconcile(a, a).first()) == (5, 5, True)
    assert tuple(reconcile(a, b).first()) == (5, 4, False)


def _run_history(spark, values):
    rows = [("total_records", float(v), dt.datetime(2024, 1, d + 1)) for d, v in enumerate(values)]
    return spark.createDataFrame(rows, "metric_name string, metric_value double, run_timestamp timestamp_ntz")


def test_metric_alerts(spark):
    hist = _run_history(spark, [100, 101, 99, 100, 130, 131])
    rows = metric_alerts(hist).orderBy("run_timestamp").collect()
    assert rows[0]["sigma_alert"] is None and rows[0]["volume_alert"] is None
    assert rows[1]["sigma_alert"] is None  # one earlier run: no deviation yet
    assert rows[3]["sigma_alert"] is False
    assert rows[4]["sigma_alert"] is True and rows[4]["volume_alert"] is True
    assert rows[5]["volume_alert"] is False
    assert rows[4]["pct_change"] == pytest.approx(30.0)


def test_metric_trend(spark):
    trend = metric_trend(_run_history(spark, [100, 110, 105]), ["total_records"])
    got = [(r["total_records_value"], r["total_records_delta"]) for r in trend.orderBy("run_timestamp").collect()]
    assert got == [(100.0, None), (110.0, 10.0), (105.0, -5.0)]


def test_json_lines(f2):
    lines = [json.loads(r[0]) for r in to_json_lines(summary(f2)).collect()]
    assert lines == [{"total_customers": 6, "churn_rate": 50.0, "avg_monthly_charges": 70.0, "avg_tenure": 31.67}]


def test_segment_rates_one_pass_matches_per_key(spark):
    from churnlens.operators import segment_rates

    df = spark.createDataFrame(
        [("a", "x", 1), ("a", None, 0), (None, "y", 1), ("b", "y", 0)], "k1 string, k2 string, ChurnFlag int"
    )
    got = [tuple(r) for r in segment_rates(df, ["k1", "k2"]).collect()]
    assert got == [
        ("k1", None, 1, 100.0), ("k1", "a", 2, 50.0), ("k1", "b", 1, 0.0),
        ("k2", "x", 1, 100.0), ("k2", "y", 2, 50.0), ("k2", None, 1, 0.0),
    ]


def test_quality_metrics_approx_distinct_option(spark, f2):
    exact = quality_metrics(f2).first()
    approx = quality_metrics(f2, distinct_method="approx").first()
    assert tuple(approx)[:4] == tuple(exact)[:4]
    assert (approx["distinct_contract_types"], approx["distinct_genders"]) == (3, 2)
    with pytest.raises(ValueError):
        quality_metrics(f2, distinct_method="guess")
