"""History compaction, stable anonymous ids, and runs that are taken up again."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.plans.job import RetentionELT
from churnlens.plans.ledger import ledger_path
from churnlens.schemas import METRICS, PRODUCTION
from churnlens.sinks import append, committed_versions, history, read_keyed
from churnlens.sinks.history import compact_history, live_files, pack_files, read_history, vacuum_history
from churnlens.sinks.id_map import anonymize_mapped, extend_id_map, id_map_table
from churnlens.sources import read_metrics, read_production

START = dt.datetime(2024, 5, 1)


def run_rows(spark, run, n=2):
    rows = [(f"m{i}", float(run), START + dt.timedelta(hours=run)) for i in range(n)]
    return spark.createDataFrame(rows, "metric_name string, metric_value double, run_timestamp timestamp_ntz").coalesce(1)


def values(df):
    return sorted((r["metric_name"], float(r["metric_value"])) for r in df.collect())


def test_pack_files():
    sizes = {"a": 6, "b": 5, "c": 4, "d": 4, "e": 1, "big": 30}
    assert pack_files(sizes, 10) == [["big"], ["a", "c"], ["b", "d", "e"]]
    assert pack_files({}, 10) == []


def test_many_appends_become_a_few_files(spark, tmp_path):
    path = str(tmp_path / "h")
    with pytest.raises(FileNotFoundError):
        read_history(spark, path, METRICS)
    for run in range(12):
        append(run_rows(spark, run), path, METRICS)
    want = values(read_history(spark, path, METRICS))
    assert compact_history(spark, path, METRICS) is not None
    assert len(live_files(spark, path)) == 1 and values(read_history(spark, path, METRICS)) == want
    assert compact_history(spark, path, METRICS) is None  # one small file is nothing to pack
    append(run_rows(spark, 12), path, METRICS)
    assert len(live_files(spark, path)) == 2 and len(values(read_metrics(spark, path))) == 26
    assert vacuum_history(spark, path, older_than=3600) == []
    assert len(vacuum_history(spark, path, older_than=-1)) == 12
    assert compact_history(spark, path, METRICS) is not None  # the small bin is packed again
    assert len(live_files(spark, path)) == 1 and len(values(read_metrics(spark, path))) == 26
    assert len(vacuum_history(spark, path, older_than=-1)) == 2
    assert len(values(read_metrics(spark, path))) == 26


def test_bins_keep_to_the_target(spark, tmp_path):
    path = str(tmp_path / "h")
    for run in range(8):
        append(run_rows(spark, run), path, METRICS)
    size = max(live_files(spark, path).values())
    before = values(read_history(spark, path, METRICS))
    compact_history(spark, path, METRICS, target_bytes=3 * size)
    assert len(live_files(spark, path)) == 3 and values(read_history(spark, path, METRICS)) == before
    # files of at least half the target are left alone
    assert compact_history(spark, path, METRICS, target_bytes=size) is None


def test_an_append_in_between_survives(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "h")
    for run in range(3):
        append(run_rows(spark, run), path, METRICS)
    original = history.pack_files

    def raced(sizes, target):
        append(run_rows(spark, 50), path, METRICS)  # after the listing, before the write
        return original(sizes, target)

    monkeypatch.setattr(history, "pack_files", raced)
    compact_history(spark, path, METRICS)
    assert len(live_files(spark, path)) == 2
    assert [v for _, v in values(read_history(spark, path, METRICS))] == [0.0, 1.0, 2.0, 50.0] * 2


def test_a_second_compaction_in_between_is_noticed(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "h")
    for run in range(3):
        append(run_rows(spark, run), path, METRICS)
    original = history.pack_files

    def raced(sizes, target):
        monkeypatch.setattr(history, "pack_files", original)
        compact_history(spark, path, METRICS)
        return original(sizes, target)

    monkeypatch.setattr(history, "pack_files", raced)
    with pytest.raises(RuntimeError, match="withdrawn"):
        compact_history(spark, path, METRICS)
    assert len(values(read_history(spark, path, METRICS))) == 6


def uuids(df):
    return {r["name"]: r["anon"] for r in df.collect()}


def people(spark, *ids):
    return spark.createDataFrame([(i, f"p{i}", "old") for i in ids], "id long, name string, anon string")


def test_ids_stay_the_same_across_loads(spark, tmp_path):
    table = id_map_table(str(tmp_path / "map"), T.LongType(), parts=4)
    first = uuids(anonymize_mapped(people(spark, 1, 2, 3, None), "id", "anon", table))
    second = uuids(anonymize_mapped(people(spark, 2, 3, 4, 4), "id", "anon", table))
    assert first["pNone"] is None and len({v for v in first.values() if v}) == 3
    assert all(first[p] == second[p] for p in ("p2", "p3")) and second["p4"] not in first.values()
    assert all(len(v) == 36 and v[14] == "4" for v in second.values())
    assert extend_id_map(people(spark, 1, 4), "id", table).version is None  # nothing new, nothing drawn
    assert read_keyed(spark, table).count() == 4
    out = anonymize_mapped(people(spark, 1), "id", "anon", table)
    assert out.columns == ["name", "anon"]


def test_a_failed_extension_draws_nothing(spark, tmp_path):
    table = id_map_table(str(tmp_path / "map"), T.LongType(), parts=2)
    kept = uuids(anonymize_mapped(people(spark, 1), "id", "anon", table))
    bad = people(spark, 1, 7).withColumn("id", F.when(F.col("id") == 7, F.raise_error(F.lit("boom"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="boom"):
        extend_id_map(bad, "id", table)
    assert read_keyed(spark, table).count() == 1
    assert uuids(anonymize_mapped(people(spark, 1, 7), "id", "anon", table))["p1"] == kept["p1"]


class Killed(BaseException):
    """What the job does not catch."""


@pytest.mark.parametrize("step", ["extract_and_load", "transform", "generate_data_quality_metrics"])
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_killed_run_is_taken_up(spark, paths, f1_csv, monkeypatch, step, when):
    def job():
        return RetentionELT(spark, paths["staging"], paths["production"], f1_csv, paths["metrics"])

    original = getattr(RetentionELT, step)

    def killed(self, *args, **options):
        if when == "after":
            original(self, *args, **options)
        raise Killed

    monkeypatch.setattr(RetentionELT, step, killed)
    with pytest.raises(Killed):
        job().run_full_pipeline("2024-05-01")
    monkeypatch.setattr(RetentionELT, step, original)
    result = job().run_full_pipeline("2024-05-01")
    assert result["status"] == "success" and result["staging_rows"] == result["production_rows"] == 6
    again = job().run_full_pipeline("2024-05-01")
    assert again["status"] == "success" and again["metrics"].keys() == result["metrics"].keys()
    assert read_metrics(spark, paths["metrics"]).count() == 6  # one set, however often the run was started
    assert read_production(spark, paths["production"]).count() == 6
    steps = [r["step"] for r in spark.read.parquet(ledger_path(job())).collect()]
    assert sorted(steps) == ["extract", "metrics", "start", "transform"]
    versions = len(committed_versions(spark, paths["production"]))
    assert versions == (2 if (step, when) == ("transform", "after") else 1)
    assert read_production(spark, paths["production"]).schema == PRODUCTION


def test_other_runs_are_runs_of_their_own(spark, paths, f1_csv):
    job = RetentionELT(spark, paths["staging"], paths["production"], f1_csv, paths["metrics"])
    assert job.run_full_pipeline("a")["status"] == job.run_full_pipeline("b")["status"] == "success"
    assert read_metrics(spark, paths["metrics"]).select("run_timestamp").distinct().count() == 2
    bad = RetentionELT(spark, paths["staging"], paths["production"], f1_csv + ".no", paths["metrics"])
    assert bad.run_full_pipeline("c")["status"] == "failed"
