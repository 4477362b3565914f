"""The CSV reader that sets bad lines aside, and the job's quarantine."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest

from churnlens.plans.job import RetentionELT, main
from churnlens.schemas import SOURCE
from churnlens.sinks import part_paths
from churnlens.sources import accepted, read_source_csv, read_staging, rejected, tag_source_csv
from tests.conftest import SOURCE_COLUMNS, f1_frame, write_csv

HEADER = ",".join(SOURCE_COLUMNS)
GOOD = '1,25.0,"Ma""le, x",3,1.5,One-Year,DSL,2.0,Yes,No'


def csv_of(tmp_path, *lines, header=HEADER, name="x.csv"):
    path = tmp_path / name
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def test_reasons(spark, tmp_path):
    path = csv_of(
        tmp_path,
        GOOD,
        "2,abc,Male,3,1.5,a,b,2.0,Yes,No",
        "3,25",
        "4,25,Male,3,1.5,a,b,2.0,Yes,No,extra",
        "5,NA,,99999999999,oops,a,b,2.0,Yes,No",
        '6,1,"unclosed,3,1.5,a,b,2.0,Yes,No',
        "7,1,q,,1e9999,a,b,2.0,Yes,No",
        "8,,,,,,,,,",
        "9,nan,<NA>,inf,1,a,b,2,Yes,No",
    )
    tagged = tag_source_csv(spark, path)
    good = {r["CustomerID"]: r for r in accepted(tagged).collect()}
    assert sorted(good) == [1, 8]
    assert good[1]["Gender"] == 'Ma"le, x' and good[1]["Age"] == 25 and good[1]["MonthlyCharges"] == Decimal("1.50")
    assert accepted(tagged).schema.simpleString() == read_source_csv(spark, csv_of(tmp_path, GOOD, name="y.csv")).schema.simpleString()
    bad = {r["record"].split(",")[0]: (r["reason"], r["column_name"]) for r in rejected(tagged).collect()}
    assert bad == {
        "2": ("value", "Age"),
        "3": ("fields", None),
        "4": ("fields", None),
        "5": ("value", "Tenure"),  # the first column that does not fit
        "6": ("fields", None),
        "7": ("value", "MonthlyCharges"),
        "9": ("value", "Tenure"),
    }
    lines = {r["record"].split(",")[0]: r for r in rejected(tagged).collect()}
    assert lines["4"]["record"] == "4,25,Male,3,1.5,a,b,2.0,Yes,No,extra"
    assert all(r["file_path"].endswith("x.csv") and r["block_start"] == 0 for r in lines.values())


def test_a_rejected_record_can_be_read_again(spark, tmp_path):
    path = csv_of(tmp_path, '2,abc,"Ma""le, x",3,1.5,a,b,2.0,Yes,No')
    record = rejected(tag_source_csv(spark, path)).first()["record"]
    mended = csv_of(tmp_path, record.replace("abc", "33"), name="mended.csv")
    row = read_source_csv(spark, mended).first()
    assert row["Age"] == 33 and row["Gender"] == 'Ma"le, x'


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_equal_to_the_strict_reader_on_good_lines(spark, tmp_path, ansi):
    rng = random.Random(3)
    cells = {"CustomerID": ["7", "8.0", " 9"], "Age": ["1", "2.5", "", "NA", "1e2"], "Tenure": ["0", "-3", "null"]}
    text = ["", "None", "x y", '"q, r"', '"a ""b"""', "é"]
    lines = [
        ",".join(
            rng.choice(cells.get(c, ["1.005", "2", "nan", "-0.5"] if "Charges" in c else text)) for c in SOURCE_COLUMNS
        )
        for _ in range(200)
    ]
    path = csv_of(tmp_path, *lines)
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        tagged = tag_source_csv(spark, path)
        assert rejected(tagged).count() == 0
        assert sorted(map(str, accepted(tagged).collect())) == sorted(map(str, read_source_csv(spark, path).collect()))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_header_and_missing_path_still_fail(spark, tmp_path):
    with pytest.raises(ValueError, match="header mismatch"):
        tag_source_csv(spark, csv_of(tmp_path, GOOD, header=HEADER.replace("Churn", "Churned")))
    with pytest.raises(FileNotFoundError):
        tag_source_csv(spark, str(tmp_path / "none.csv"))
    folder = tmp_path / "two"
    folder.mkdir()
    csv_of(folder, GOOD, name="a.csv")
    csv_of(folder, GOOD, header=",".join(reversed(SOURCE_COLUMNS)), name="b.csv")
    with pytest.raises(Exception, match="(?i)header"):
        accepted(tag_source_csv(spark, str(folder))).collect()


def test_columns_in_another_order(spark, tmp_path):
    frame = f1_frame()[list(reversed(SOURCE_COLUMNS))]
    frame["Age"] = frame["Age"].astype(object)
    frame.loc[0, "Age"] = "old"
    tagged = tag_source_csv(spark, write_csv(tmp_path, frame))
    assert accepted(tagged).columns == [f.name for f in SOURCE.fields] and accepted(tagged).count() == 5
    assert rejected(tagged).first()["column_name"] == "Age"


def test_job_with_quarantine(spark, tmp_path, paths):
    path = csv_of(tmp_path, GOOD, "2,abc,Male,3,1.5,a,b,2.0,Yes,No", "3,25")
    kept = str(tmp_path / "quarantine")
    job = RetentionELT(spark, paths["staging"], paths["production"], path, paths["metrics"], quarantine_path=kept)
    result = job.run_full_pipeline()
    assert result["status"] == "success" and result["staging_rows"] == result["production_rows"] == 1
    bad = spark.read.parquet(kept).collect()
    assert sorted(r["reason"] for r in bad) == ["fields", "value"] and all(r["load_timestamp"] for r in bad)
    strict = RetentionELT(spark, paths["staging"], paths["production"], path, paths["metrics"])
    assert strict.run_full_pipeline()["status"] == "failed"
    assert read_staging(spark, paths["staging"]).count() == 1
    clean = RetentionELT(
        spark, paths["staging"], paths["production"], csv_of(tmp_path, GOOD, name="z.csv"), quarantine_path=str(tmp_path / "no")
    )
    assert clean.extract_and_load() == 1 and not (tmp_path / "no").exists()
    with pytest.raises(ValueError, match="excludes"):
        RetentionELT(spark, "a", "b", path, quarantine_path=kept, ragged_csv="pad")


def test_job_merges_files_by_customer(spark, tmp_path, paths, f1_csv):
    def job(csv):
        return RetentionELT(
            spark, paths["staging"], paths["production"], csv, paths["metrics"], incremental=True, staging_part_ids=2
        )

    first = job(f1_csv).run_full_pipeline()
    assert (first["staging_rows"], first["production_rows"]) == (6, 6)
    loaded = {r["CustomerID"]: r["load_timestamp"] for r in job(f1_csv).staging().collect()}
    change = f1_frame().iloc[[0, 2]].assign(Tenure=[35, 12])
    more = f1_frame().iloc[[1]].assign(CustomerID=900)
    import pandas as pd

    second_csv = write_csv(tmp_path, pd.concat([change, more]), "second.csv")
    second = job(second_csv).run_full_pipeline()
    assert second["status"] == "success" and (second["staging_rows"], second["production_rows"]) == (3, 7)
    rows = {r["CustomerID"]: r for r in job(f1_csv).staging().collect()}
    assert len(rows) == 7 and rows[101]["Tenure"] == 35 and rows[103]["Tenure"] == 12
    assert rows[103]["load_timestamp"] == loaded[103] and rows[101]["load_timestamp"] > loaded[101]
    versions = {path.split("/v=")[1][:15] for path in part_paths(spark, job(f1_csv).keyed_staging).values()}
    assert len(versions) == 2  # ids 102 to 106 still lie in the first load's files


def test_command_line_merges(spark, tmp_path, paths, f1_csv, monkeypatch):
    for name, value in (("STAGING_DB_PATH", paths["staging"]), ("PRODUCTION_DB_PATH", paths["production"]), ("CSV_PATH", f1_csv)):
        monkeypatch.setenv(name, value)
    monkeypatch.setenv("QUARANTINE_PATH", str(tmp_path / "q"))
    assert main(["--incremental"]) == 0 and main(["--incremental", "--step", "extract"]) == 0
    assert main(["--incremental", "--step", "transform"]) == 0
