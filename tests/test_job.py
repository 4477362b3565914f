"""The ELT job end to end on small CSV files (fixtures F1 and F3)."""

from __future__ import annotations

import sys
from decimal import Decimal

import pandas as pd
import pytest

from churnlens.operators import latest_metrics
from churnlens.plans.job import RetentionELT
from churnlens.plans.production import production_comparable
from churnlens.schemas import METRICS, PRODUCTION, STAGING
from churnlens.sinks import committed_versions
from churnlens.sources import read_metrics, read_production, read_source_csv, read_staging
from tests.conftest import SOURCE_COLUMNS, f1_frame, write_csv

# Golden production rows for F1, without the random id and the clocks, worked
# out by hand: median age of 29, 36, 45, 61 is 40.5 -> 40, mean charge 90.00.
F1_GOLDEN = [
    (101, 61, "Female", 36, Decimal("50.00"), "One-Year", "DSL", Decimal("1800.00"), "No", "Yes", 1, "Low", "Medium"),
    (102, 40, "Male", 37, Decimal("50.01"), "Month-to-Month", "None", Decimal("0.00"), "No", "No", 0, "Medium", "Long"),
    (103, 29, "Unknown", 12, Decimal("90.00"), "Two-Year", "Fiber Optic", Decimal("95.50"), "Yes", "No", 0, "Medium", "New"),
    (104, 45, "Male", 13, Decimal("100.00"), "Month-to-Month", "DSL", Decimal("1300.00"), "Yes", "Yes", 1, "Medium", "Medium"),
    (105, 36, "Female", 0, Decimal("100.50"), "Two-Year", "None", Decimal("0.00"), "No", "yes", 0, "High", "nan"),
    (106, 40, "Male", 1, Decimal("149.49"), "One-Year", "Fiber Optic", Decimal("149.49"), "No", "No", 0, "High", "New"),
]


def job(spark, paths, csv):
    return RetentionELT(spark, paths["staging"], paths["production"], csv, paths["metrics"])


def test_csv_source_types_and_nulls(spark, f1_csv):
    df = read_source_csv(spark, f1_csv)
    rows = df.orderBy("CustomerID").collect()
    assert rows[1]["Age"] is None and rows[0]["Age"] == 61  # "61.0" in the file
    assert rows[2]["Gender"] is None and rows[1]["TotalCharges"] is None
    assert rows[0]["MonthlyCharges"] == Decimal("50.00")


def test_csv_missing_file_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_source_csv(spark, str(tmp_path / "nope.csv"))


def test_csv_columns_matched_by_name(spark, tmp_path):
    frame = f1_frame()[list(reversed(SOURCE_COLUMNS))]
    df = read_source_csv(spark, write_csv(tmp_path, frame))
    assert df.columns == SOURCE_COLUMNS
    assert df.orderBy("CustomerID").first()["Age"] == 61


def test_csv_header_mismatch_raises(spark, tmp_path):
    frame = f1_frame().rename(columns={"Churn": "Churned"})
    with pytest.raises(ValueError, match="header mismatch"):
        read_source_csv(spark, write_csv(tmp_path, frame))


def test_full_pipeline_f1(spark, paths, f1_csv):
    result = job(spark, paths, f1_csv).run_full_pipeline()
    assert result["status"] == "success"
    assert result["staging_rows"] == 6 and result["production_rows"] == 6
    m = result["metrics"]
    assert m["total_records"] == 6 and m["churn_rate_percent"] == 33.33
    assert m["avg_monthly_charges"] == 90.0 and m["avg_tenure_months"] == 16.5
    assert m["distinct_contract_types"] == 3 and m["distinct_genders"] == 3

    prod = read_production(spark, paths["production"])
    assert prod.schema == PRODUCTION
    rows = prod.collect()
    assert len({r["AnonymizedCustomerID"] for r in rows}) == 6
    assert all(len(r["AnonymizedCustomerID"]) == 36 for r in rows)
    assert all(r["processed_timestamp"] is not None and r["load_timestamp"] is not None for r in rows)
    assert prod.columns[0] == "AnonymizedCustomerID" and prod.columns[-2:] == [
        "load_timestamp", "processed_timestamp"]

    metrics = read_metrics(spark, paths["metrics"])
    assert metrics.schema == METRICS and metrics.count() == 6
    assert metrics.select("run_timestamp").distinct().count() == 1


def test_production_golden_rows(spark, f1_csv):
    got = [tuple(r) for r in production_comparable(read_source_csv(spark, f1_csv)).orderBy("CustomerID").collect()]
    assert got == F1_GOLDEN


def test_loads_repeat_and_keep_their_versions(spark, paths, f1_csv):
    elt = job(spark, paths, f1_csv)
    assert [elt.extract_and_load() for _ in range(3)] == [6, 6, 6]
    assert read_staging(spark, paths["staging"]).count() == 6
    assert read_staging(spark, paths["staging"]).schema == STAGING
    assert len(committed_versions(spark, paths["staging"])) == 3


def _versioned(spark, base, rows):
    from churnlens.sinks import publish

    return publish(spark.range(rows), base)


def test_publish_does_not_follow_a_clock(spark, tmp_path, monkeypatch):
    import time

    from churnlens.sinks import current_version_path

    base = str(tmp_path / "t")
    for rows, clock in ((2, 2e9), (3, 1e9), (4, 1.5e9)):
        monkeypatch.setattr(time, "time", lambda clock=clock: clock)
        path, written = _versioned(spark, base, rows)
        assert written == rows and current_version_path(spark, base) == path
        assert spark.read.parquet(path).count() == rows
    assert len(committed_versions(spark, base)) == 3


def test_a_failed_write_is_not_current_and_two_writers_are_told(spark, tmp_path, monkeypatch):
    from churnlens.sinks import current_version_path

    base = str(tmp_path / "t")
    first, _ = _versioned(spark, base, 2)
    (tmp_path / "t" / "v=000000000000009-dead").mkdir()  # left by a failed write
    assert current_version_path(spark, base) == first
    second, _ = _versioned(spark, base, 3)
    assert second.split("v=")[1].startswith("000000000000010-") and current_version_path(spark, base) == second
    # another writer saw the same listing and took a later place in it
    module = sys.modules["churnlens.sinks.publish"]
    monkeypatch.setattr(module, "_new_version_name", lambda *a: "v=000000000000009-aaaa")
    with pytest.raises(RuntimeError, match="another writer"):
        _versioned(spark, base, 4)
    assert current_version_path(spark, base) == second


def test_vacuum_spares_the_current_version(spark, tmp_path):
    import os

    from churnlens.sinks import current_version_path, vacuum

    base = tmp_path / "t"
    for rows in (1, 2, 3):
        _versioned(spark, str(base), rows)
    (base / "v=000000000000000-dead").mkdir()
    assert vacuum(spark, str(base), older_than=3600) == []
    for child in base.iterdir():
        os.utime(child, (1, 1))
    current = current_version_path(spark, str(base))
    assert len(vacuum(spark, str(base), older_than=3600)) == 3
    assert [str(p) for p in base.iterdir() if p.name.startswith("v=")] == [current]
    assert vacuum(spark, str(tmp_path / "none"), older_than=0) == []


def test_partition_overwrite_and_catalog_table(spark, tmp_path):
    from pyspark.sql import types as T

    from churnlens.sinks import create_table_as, overwrite_partitions, read_partitioned

    schema = T.StructType.fromDDL("day string, id bigint, amount int")
    path = str(tmp_path / "p")
    rows = [("a", 1, 1), ("a", 2, 2), ("b", 3, 3)]
    assert overwrite_partitions(spark.createDataFrame(rows, schema), path, schema, ["day"]) == 3
    assert overwrite_partitions(spark.createDataFrame([("b", 4, 4)], schema), path, schema, ["day"]) == 1
    back = read_partitioned(spark, path, schema)
    assert back.schema == schema and sorted(map(tuple, back.collect())) == [("a", 1, 1), ("a", 2, 2), ("b", 4, 4)]
    name = "made_from_partitions"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    create_table_as(back.filter("amount > 1").coalesce(1), name)
    assert spark.table(name).count() == 2
    with pytest.raises(Exception):
        create_table_as(back, name)
    spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("ragged", ["fail", "pad"])
@pytest.mark.parametrize("second", ["Tenure and Age swapped", "renamed"])
def test_every_file_has_the_first_files_header(spark, tmp_path, ragged, second):
    folder = tmp_path / "many"
    folder.mkdir()
    f1_frame().to_csv(folder / "a.csv", index=False)
    other = f1_frame()
    if second == "renamed":
        other = other.rename(columns={"Churn": "Left"})
    else:
        order = list(SOURCE_COLUMNS)
        i, j = order.index("Age"), order.index("Tenure")
        order[i], order[j] = order[j], order[i]
        other = other[order]
    other.to_csv(folder / "b.csv", index=False)
    with pytest.raises(Exception):
        read_source_csv(spark, str(folder), ragged=ragged).collect()


@pytest.mark.parametrize("cell", ["3000000000", "inf", "1e300", "-2147483649", "NAN"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_cells_out_of_range_fail(spark, tmp_path, cell, ansi):
    frame = f1_frame()
    frame["Tenure"] = frame["Tenure"].astype(object)
    frame.loc[0, "Tenure"] = cell
    path = write_csv(tmp_path, frame)
    previous = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        with pytest.raises(Exception):
            read_source_csv(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", previous)


def test_ids_and_totals_beyond_an_int(spark, paths, tmp_path):
    frame = f1_frame()
    frame["CustomerID"] = [str(9007199254740993 + k) for k in range(6)]
    frame.loc[0, "TotalCharges"] = 123456789012.25
    res = job(spark, paths, write_csv(tmp_path, frame)).run_full_pipeline()
    assert res["status"] == "success"
    staged = read_staging(spark, paths["staging"]).orderBy("CustomerID").collect()
    assert [r["CustomerID"] for r in staged] == [9007199254740993 + k for k in range(6)]
    assert staged[0]["TotalCharges"] == Decimal("123456789012.25")


def test_failed_load_keeps_previous_table(spark, paths, f1_csv, tmp_path):
    elt = job(spark, paths, f1_csv)
    elt.extract_and_load()
    bad = pd.DataFrame({c: ["x"] for c in SOURCE_COLUMNS})  # 'x' is not an integer
    elt_bad = job(spark, paths, write_csv(tmp_path, bad, "bad.csv"))
    with pytest.raises(Exception):
        elt_bad.extract_and_load()
    assert read_staging(spark, paths["staging"]).count() == 6


def test_missing_source_fails_softly(spark, paths):
    result = job(spark, paths, "/nonexistent/file.csv").run_full_pipeline()
    assert result["status"] == "failed" and "error" in result


def test_missing_source_raises_on_load(spark, paths):
    with pytest.raises(FileNotFoundError):
        job(spark, paths, "/nonexistent/file.csv").extract_and_load()


def test_transform_without_staging_raises(spark, paths, f1_csv):
    with pytest.raises(FileNotFoundError):
        job(spark, paths, f1_csv).transform()


def test_header_only_csv(spark, paths, tmp_path):
    csv = write_csv(tmp_path, pd.DataFrame(columns=SOURCE_COLUMNS))
    elt = job(spark, paths, csv)
    assert elt.extract_and_load() == 0
    assert elt.transform() == 0
    m = elt.generate_data_quality_metrics()
    assert m["total_records"] == 0 and m["avg_monthly_charges"] is None


def test_all_missing_values(spark, paths, tmp_path):
    frame = pd.DataFrame({c: [None] * 3 for c in SOURCE_COLUMNS})
    frame["CustomerID"] = [1, 2, 3]
    elt = job(spark, paths, write_csv(tmp_path, frame))
    elt.extract_and_load()
    assert elt.transform() == 3
    prod = read_production(spark, paths["production"])
    assert prod.where("Gender = 'Unknown'").count() == 3
    assert prod.where("Age IS NULL").count() == 3  # median of nothing: left NULL


def test_single_row_and_thousand_rows(spark, paths, tmp_path):
    one = f1_frame().iloc[[0]]
    res = job(spark, paths, write_csv(tmp_path, one, "one.csv")).run_full_pipeline()
    assert (res["status"], res["staging_rows"], res["production_rows"]) == ("success", 1, 1)
    many = pd.concat([f1_frame().iloc[[0]]] * 1000, ignore_index=True)
    many["CustomerID"] = range(1, 1001)
    res = job(spark, paths, write_csv(tmp_path, many, "many.csv")).run_full_pipeline()
    assert (res["status"], res["staging_rows"], res["production_rows"]) == ("success", 1000, 1000)


def test_special_characters(spark, paths, tmp_path):
    frame = f1_frame().iloc[:2].copy()
    frame["Gender"] = ["M'ale", 'Fe"male']
    res = job(spark, paths, write_csv(tmp_path, frame)).run_full_pipeline()
    assert res["status"] == "success"
    genders = {r[0] for r in read_staging(spark, paths["staging"]).select("Gender").collect()}
    assert genders == {"M'ale", 'Fe"male'}


def test_metric_history_grows_and_latest_ten(spark, paths, f1_csv):
    elt = job(spark, paths, f1_csv)
    elt.run_full_pipeline()
    elt.run_full_pipeline()
    history = read_metrics(spark, paths["metrics"])
    assert history.count() == 12
    latest = latest_metrics(history).collect()
    assert len(latest) == 10
    assert latest[0]["metric_name"] == "distinct_genders"


def test_partitioned_publish_prunes_partitions(spark, paths, f1_csv):
    from churnlens.plans.production import build_production
    from churnlens.schemas import PRODUCTION
    from churnlens.sinks import publish

    staging_elt = job(spark, paths, f1_csv)
    staging_elt.extract_and_load()
    prod = build_production(read_staging(spark, paths["staging"]))
    path, rows = publish(prod, paths["production"], PRODUCTION, partition_by=["ContractType"])
    assert rows == 6
    assert read_production(spark, paths["production"]).schema == PRODUCTION
    back = spark.read.parquet(path).where("ContractType = 'Two-Year'")
    assert back.count() == 2
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ContractType" in plan


def test_bad_value_fails_even_without_ansi(spark, tmp_path):
    frame = f1_frame()
    frame["Tenure"] = frame["Tenure"].astype(object)
    frame.loc[0, "Tenure"] = "twelve"
    path = write_csv(tmp_path, frame)
    previous = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            with pytest.raises(Exception):
                read_source_csv(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", previous)


def _ragged_csv(tmp_path, extra_line: str) -> str:
    header = ",".join(SOURCE_COLUMNS)
    good = "1,25,Male,12,50.0,Month-to-Month,DSL,600.0,Yes,No"
    path = tmp_path / "ragged.csv"
    path.write_text("\n".join([header, good, extra_line]) + "\n")
    return str(path)


def test_ragged_short_row(spark, tmp_path):
    path = _ragged_csv(tmp_path, "2,40,Female")
    with pytest.raises(Exception):
        read_source_csv(spark, path).collect()
    rows = read_source_csv(spark, path, ragged="pad").orderBy("CustomerID").collect()
    assert len(rows) == 2
    assert (rows[1]["Age"], rows[1]["Gender"], rows[1]["Churn"]) == (40, "Female", None)


def test_ragged_long_row_fails_even_when_padding(spark, tmp_path):
    path = _ragged_csv(tmp_path, "2,40,Female,1,1.0,One-Year,DSL,1.0,No,No,surplus")
    with pytest.raises(Exception, match="more fields"):
        read_source_csv(spark, path, ragged="pad").collect()


def test_two_runs_publish_identical_content(spark, paths, f1_csv):
    elt = job(spark, paths, f1_csv)
    volatile = ["AnonymizedCustomerID", "load_timestamp", "processed_timestamp"]

    def content():
        prod = read_production(spark, paths["production"]).drop(*volatile)
        return sorted(tuple(r) for r in prod.collect())

    assert elt.run_full_pipeline()["status"] == "success"
    first = content()
    first_ids = {r[0] for r in read_production(spark, paths["production"]).select("AnonymizedCustomerID").collect()}
    assert elt.run_full_pipeline()["status"] == "success"
    assert content() == first
    second_ids = {r[0] for r in read_production(spark, paths["production"]).select("AnonymizedCustomerID").collect()}
    assert not first_ids & second_ids  # fresh random ids on every run


def test_reader_keeps_its_version_across_a_refresh(spark, paths, f1_csv, tmp_path):
    elt = job(spark, paths, f1_csv)
    elt.run_full_pipeline()
    reader = read_production(spark, paths["production"])  # bound to the current version
    before = sorted(r[0] for r in reader.select("AnonymizedCustomerID").collect())

    bigger = pd.concat([f1_frame()] * 3, ignore_index=True)
    bigger["CustomerID"] = range(1, 19)
    for _ in range(3):
        job(spark, paths, write_csv(tmp_path, bigger, "bigger.csv")).run_full_pipeline()

    assert read_production(spark, paths["production"]).count() == 18  # new readers see the refresh
    after = sorted(r[0] for r in reader.select("AnonymizedCustomerID").collect())
    assert after == before  # the earlier reader still reads its whole version


def test_charges_binned_before_rounding(spark, tmp_path):
    frame = f1_frame().iloc[:4].copy()
    frame["MonthlyCharges"] = [100.0, 100.0, 100.01, None]  # mean 100.00333...
    rows = production_comparable(read_source_csv(spark, write_csv(tmp_path, frame))).orderBy("CustomerID").collect()
    filled = rows[3]
    assert filled["MonthlyCharges"] == Decimal("100.00")
    assert filled["MonthlyChargesCategory"] == "High"  # banded on the unrounded mean
    assert rows[0]["MonthlyChargesCategory"] == "Medium"  # 100.00 itself is (50, 100]


def test_main_uses_environment_and_exit_status(spark, paths, f1_csv, monkeypatch):
    from churnlens.plans.job import main

    monkeypatch.setenv("STAGING_DB_PATH", paths["staging"])
    monkeypatch.setenv("PRODUCTION_DB_PATH", paths["production"])
    monkeypatch.setenv("METRICS_PATH", paths["metrics"])
    monkeypatch.setenv("CSV_PATH", f1_csv)
    assert main() == 0
    assert read_production(spark, paths["production"]).count() == 6
    assert read_metrics(spark, paths["metrics"]).count() == 6
    monkeypatch.setenv("CSV_PATH", "/nonexistent/file.csv")
    assert main() == 1
    monkeypatch.delenv("CSV_PATH")
    assert main() == 2


@pytest.mark.parametrize("handed", [True, False])
def test_steps_run_one_at_a_time(spark, paths, f1_csv, monkeypatch, caplog, handed):
    from churnlens.plans.job import main

    for key, value in (("STAGING", paths["staging"]), ("PRODUCTION", paths["production"])):
        monkeypatch.setenv(f"{key}_DB_PATH", value)
    monkeypatch.setenv("METRICS_PATH", paths["metrics"])
    monkeypatch.setenv("CSV_PATH", f1_csv)
    assert main(["--step", "transform"]) == 1  # nothing staged yet
    assert main(["--step", "extract"]) == 0
    assert main(["--step", "transform", *(["--staging-rows", "7"] if handed else [])]) == 0
    assert ("Row count mismatch" in caplog.text) == handed
    assert main(["--step", "metrics"]) == 0
    assert read_production(spark, paths["production"]).count() == 6
    assert read_metrics(spark, paths["metrics"]).count() == 6


def test_from_paths(spark, paths, f1_csv):
    elt = RetentionELT.from_paths(
        staging_db_path=paths["staging"], production_db_path=paths["production"], csv_path=f1_csv,
        metrics_path=paths["metrics"],
    )
    assert elt.spark is spark
    assert elt.run_full_pipeline()["production_rows"] == 6
