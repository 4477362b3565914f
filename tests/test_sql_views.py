"""SQL over the registered views, and the named reports, on hand-worked values."""

from __future__ import annotations

import json

import pytest

from churnlens.plans.job import RetentionELT
from churnlens.plans.reports import main, report, report_json
from churnlens.sinks import write_json
from churnlens.sources.tables import register_views


@pytest.fixture
def loaded(spark, paths, f1_csv):
    elt = RetentionELT(spark, paths["staging"], paths["production"], f1_csv, paths["metrics"])
    assert elt.run_full_pipeline()["status"] == "success"
    return paths


def test_views(spark, loaded):
    names = ("raw_customers", "customers", "checks")
    assert register_views(spark, loaded["staging"], loaded["production"], loaded["metrics"], view_names=names) == list(names)
    described = [r["col_name"] for r in spark.sql("DESCRIBE customers").collect()]
    assert described[0] == "AnonymizedCustomerID" and described[-2:] == ["load_timestamp", "processed_timestamp"]
    churned = spark.sql("SELECT COUNT_IF(ChurnFlag = 1), MAX(Tenure), SUM(TotalCharges) FROM customers").first()
    assert [float(x) for x in churned] == [2.0, 37.0, 3344.99]
    long_stay = spark.sql("SELECT ContractType FROM customers WHERE Tenure > 12 EXCEPT SELECT 'One-Year'").collect()
    assert [r[0] for r in long_stay] == ["Month-to-Month"]
    stored = spark.sql("SELECT COUNT(DISTINCT metric_name), COUNT(DISTINCT run_timestamp) FROM checks").first()
    assert tuple(stored) == (6, 1)
    assert spark.sql("SELECT COUNT(*) FROM raw_customers WHERE Age IS NULL").first()[0] == 2


def test_reports_by_name(spark, loaded):
    prod, met = loaded["production"], loaded["metrics"]
    assert tuple(report(spark, "summary", prod, met).first()) == (6, 33.33, 90.0, 16.5)
    want = {
        "churn_by_contract": [("Month-to-Month", 2, 50.0), ("One-Year", 2, 50.0), ("Two-Year", 2, 0.0)],
        "churn_by_service": [("DSL", 2, 100.0), ("Fiber Optic", 2, 0.0), ("None", 2, 0.0)],
        "churn_by_tenure": [("Medium", 2, 100.0), ("Long", 1, 0.0), ("New", 2, 0.0), ("nan", 1, 0.0)],
        "churn_by_charges": [("Low", 1, 100.0), ("Medium", 3, 33.33), ("High", 2, 0.0)],
    }
    for name, rows in want.items():
        assert [tuple(r) for r in report(spark, name, prod, met).collect()] == rows
    analytics = {r["contract_type"]: r for r in report(spark, "analytics", prod, met).collect()}
    assert analytics["One-Year"]["avg_tenure"] == 18.5 and analytics["One-Year"]["contract_count"] == 2
    kpi = report(spark, "kpi_display", prod, met).first()
    assert (kpi["rate_band"], kpi["avg_tenure_display"]) == ("green", 16.5)
    segments = {(r["segment_key"], r["segment"]): r["rate_band"] for r in report(spark, "segments", prod, met).collect()}
    assert segments["InternetService", "DSL"] == "red" and segments["ContractType", "One-Year"] == "yellow"
    metrics = [json.loads(r[0]) for r in report_json(spark, "metrics", prod, met).collect()]
    assert metrics[0]["metric_name"] == "distinct_genders" and len(metrics) == 6
    with pytest.raises(KeyError):
        report(spark, "nope", prod, met)


def test_printed_json(spark, loaded, capsys):
    where = ["--production", loaded["production"], "--metrics", loaded["metrics"]]
    assert main(["summary", *where]) == 0
    assert json.loads(capsys.readouterr().out) == {
        "total_customers": 6, "churn_rate": 33.33, "avg_monthly_charges": 90.0, "avg_tenure": 16.5}
    assert main(["churn_by_charges", *where]) == 0
    assert [r["count"] for r in json.loads(capsys.readouterr().out)] == [1, 3, 2]


def test_null_fields_stay_in_json(spark, tmp_path):
    from churnlens.operators import segment_rate, to_json_lines

    df = spark.createDataFrame([(None, 1), ("a", 0)], "ContractType string, ChurnFlag int")
    rates = segment_rate(df)
    assert [json.loads(r[0]) for r in to_json_lines(rates).collect()][0] == {
        "contract_type": None, "count": 1, "churn_rate": 100.0}
    write_json(rates.coalesce(1), str(tmp_path / "out"))
    lines = [json.loads(x) for f in (tmp_path / "out").glob("part-*.json") for x in f.read_text().splitlines()]
    assert lines[0]["contract_type"] is None and lines[1] == {"contract_type": "a", "count": 1, "churn_rate": 0.0}
