"""Mergeable moments: equal to the alerts over the whole history, however it is cut."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from churnlens.operators import advanced_state, incremental_alerts, merged_state, metric_alerts, metric_state
from churnlens.operators.quality import last_not_null
from churnlens.schemas import METRICS, METRIC_STATE
from churnlens.sinks import append, read_published
from churnlens.streaming import metrics_monitor, start_metrics_monitor

START = dt.datetime(2024, 3, 1)


def history(spark, values, start=0):
    rows = [
        (name, None if v is None else float(v), START + dt.timedelta(hours=start + i)) for name, series in values.items() for i, v in enumerate(series)
    ]
    return spark.createDataFrame(rows, "metric_name string, metric_value double, run_timestamp timestamp_ntz")


def by_run(df):
    return {(r["metric_name"], r["run_timestamp"]): r for r in df.collect()}


def close(a, b):
    assert a.keys() == b.keys()
    for k in a:
        for c in a[k].asDict():
            x, y = a[k][c], b[k][c]
            assert x == y or x == pytest.approx(y, rel=1e-8, abs=1e-8), (k, c, x, y)


@pytest.mark.parametrize("cuts", [(0, 9), (0, 1, 2, 5, 9)])
def test_any_cut_gives_the_alerts_of_the_whole(spark, cuts):
    rng = random.Random(2)
    values = {
        "total_records": [1000, 1010, 900, None, 905, 0, 0, 2000, 1e15],
        "rate": [1e6 + rng.random() for _ in range(9)],  # a large mean, a small spread
        "flat": [5.0] * 9,
    }
    whole = history(spark, values).cache()
    ts = [START + dt.timedelta(hours=c) for c in cuts]
    state, out = metric_state(whole.filter("false")), {}
    for low, high in zip(ts, ts[1:], strict=False):
        rows = whole.filter((F.col("run_timestamp") >= F.lit(low)) & (F.col("run_timestamp") < F.lit(high)))
        out |= by_run(incremental_alerts(state, rows))
        state = spark.createDataFrame(advanced_state(state, rows).collect(), METRIC_STATE)
    close(out, by_run(metric_alerts(whole)))
    assert state.count() == 3


def test_states_merge_in_any_order(spark):
    rng = random.Random(4)
    values = {"m": [rng.gauss(1e6, 1) for _ in range(40)], "none": [None] * 40}
    rows = history(spark, values)
    parts = [metric_state(rows.filter(F.expr(f"hour(run_timestamp) % 5 = {k}"))) for k in range(5)]
    rng.shuffle(parts)
    together = parts[0]
    for p in parts[1:]:
        together = together.unionByName(p)
    got = {r["metric_name"]: r for r in merged_state(together).collect()}
    want = {r["metric_name"]: r for r in metric_state(rows).collect()}
    for c in ("n", "mean", "m2", "last_value", "last_timestamp"):
        assert got["m"][c] == pytest.approx(want["m"][c], rel=1e-9) if c in ("mean", "m2") else got["m"][c] == want["m"][c]
    assert got["none"]["n"] == 0 and got["none"]["mean"] is None and got["none"]["last_value"] is None


def test_a_value_right_at_the_limit_raises_no_alert(spark):
    state = spark.createDataFrame([("m", 2, 33.0, 36.0, 33.0, START - dt.timedelta(hours=1))], METRIC_STATE)
    at = by_run(incremental_alerts(state, history(spark, {"m": [45.0]})))[("m", START)]
    assert at["prior_std"] == 6.0 and at["sigma_alert"] is False
    over = by_run(incremental_alerts(state, history(spark, {"m": [45.0001]})))[("m", START)]
    assert over["sigma_alert"] is True


def test_a_run_reads_its_own_rows_and_the_state(spark):
    rows = history(spark, {"m": [1.0, 2.0]})
    state = spark.createDataFrame([("m", 5, 1.0, 2.0, 3.0, START)], METRIC_STATE)
    alert = by_run(incremental_alerts(state, rows, volume_metric="m"))[("m", START)]
    assert alert["prior_mean"] == 1.0 and alert["prior_std"] == pytest.approx(0.5**0.5)
    assert alert["pct_change"] == pytest.approx(-200 / 3) and alert["volume_alert"] is True


def test_monitor_judges_each_trigger_by_the_state(spark, tmp_path):
    path, out, alerts = str(tmp_path / "m"), str(tmp_path / "out"), str(tmp_path / "alerts")
    rng = random.Random(7)
    whole = None
    for run in range(4):
        rows = history(spark, {"total_records": [rng.randint(90, 130)], "avg": [rng.random()]}, start=run)
        whole = rows if whole is None else whole.unionByName(rows)
        append(rows, path, METRICS)
        # the last trigger starts again without a checkpoint: the whole history is new to it
        start_metrics_monitor(
            spark, path, out, str(tmp_path / f"ckpt{run // 3}"), available_now=True, alerts_base=alerts
        ).awaitTermination(120)
        stored = spark.read.schema(METRICS).parquet(path)
        newest = stored.agg(F.max("run_timestamp")).first()[0]
        want = {k: v for k, v in by_run(metric_alerts(stored)).items() if k[1] == newest}
        from churnlens.sinks import current_version_path

        close(by_run(spark.read.parquet(current_version_path(spark, alerts))), want)
        latest = {r["metric_name"]: r["last_metric_value"] for r in read_published(spark, out, metrics_monitor.SNAPSHOT).collect()}
        assert latest == {r["metric_name"]: r["last_metric_value"] for r in last_not_null(stored, "metric_name", "metric_value", ["run_timestamp"]).collect()}
        state = read_published(spark, f"{alerts}_state", metrics_monitor.MONITOR_STATE).collect()
        assert {r["n"] for r in state} == {run + 1}


def test_a_replayed_epoch_counts_once(spark, tmp_path):
    base, rows = str(tmp_path / "state"), history(spark, {"m": [1.0, 2.0]})
    assert metrics_monitor._alert_state(spark, base, rows, rows, "s", 0).count() == 0
    stamped = metric_state(rows).withColumns({"stream": F.lit("s"), "epoch": F.lit(0).cast("long")})
    metrics_monitor.publish(stamped, base, metrics_monitor.MONITOR_STATE)
    assert metrics_monitor._alert_state(spark, base, rows, rows, "s", 0) is None
    assert metrics_monitor._alert_state(spark, base, rows, rows, "s", 1).first()["n"] == 2
    assert metrics_monitor._alert_state(spark, base, rows, rows, "other", 0).count() == 0
