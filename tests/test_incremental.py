"""Change detection, incremental loads, reads of versions, and their difference."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.operators.changes import detect_changes, one_per_key, row_difference
from churnlens.sinks import KeyedTable, load_incremental, part_paths, read_keyed, refresh_keyed, vacuum_keyed
from churnlens.sinks import incremental, publish, read_published
from churnlens.sinks.storage import list_children

SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("amount", T.DecimalType(10, 2)),
        T.StructField("at", T.TimestampNTZType()),
    ]
)


def rows(spark, *cells):
    return spark.createDataFrame([(*c, None, None) for c in cells], SCHEMA)


def table(tmp_path, part_by="id DIV 10", **options):
    return KeyedTable(str(tmp_path / "table"), SCHEMA, ("id",), part_by, **options)


def content(df):
    return {r["id"]: r["name"] for r in df.collect()}


def test_detect_changes(spark):
    old = spark.createDataFrame([(1, "a", None), (2, None, "b"), (3, "c", "d"), (None, "n", "n")], "id long, x string, y string")
    new = spark.createDataFrame(
        [(1, None, "a"), (2, None, "b"), (3, "c", "e"), (4, None, None), (None, "n", "n")], "id long, x string, y string"
    )
    found = {r["id"]: r["change"] for r in detect_changes(old, new, ["id"]).collect()}
    assert found == {1: "update", 2: "unchanged", 3: "update", 4: "insert", None: "unchanged"}
    ignoring = {r["id"]: r["change"] for r in detect_changes(old, new, ["id"], ignored=["y"]).collect()}
    assert ignoring == {1: "update", 2: "unchanged", 3: "unchanged", 4: "insert", None: "unchanged"}


def test_row_difference(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (None, "x")], "id long, v string")
    new = spark.createDataFrame([("b", 2), ("z", 3), ("new", 9), ("y", None)], "v string, id long")
    got = {r["id"]: r["difference"] for r in row_difference(old, new, ["id"]).collect()}
    assert got == {1: "removed", 3: "changed", 9: "added", None: "changed"}
    with pytest.raises(ValueError, match="columns differ"):
        row_difference(old, new.withColumn("more", F.lit(1)), ["id"])


def test_one_per_key(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, "d", None), (None, "e", 1)], "id long, v string, at int")
    assert content(one_per_key(df, ["id"], ["at"]).withColumnRenamed("v", "name")) == {1: "b", 2: "d", None: "e"}
    twice = df.filter("id <> 1").unionByName(df.filter("id <> 1"))
    assert sorted(r["v"] for r in one_per_key(twice, ["id"]).collect()) == ["d"]
    with pytest.raises(Exception, match="share the key"):
        one_per_key(df, ["id"]).collect()
    assert one_per_key(df.select("id"), ["id"]).count() == 3


def test_load_writes_only_the_parts_that_change(spark, tmp_path):
    t = table(tmp_path)
    first = load_incremental(rows(spark, *[(i, f"n{i}") for i in range(50)], (None, "null key")), t)
    assert (first.inserted, first.updated, first.unchanged, first.parts) == (51, 0, 0, (-1, 0, 1, 2, 3, 4))
    second = load_incremental(rows(spark, (3, "new"), (4, "n4"), (12, "n12"), (47, "other"), (99, "add"), (None, "null key")), t)
    assert (second.inserted, second.updated, second.unchanged, second.parts) == (1, 2, 3, (0, 4, 9))
    paths = part_paths(spark, t)
    assert {p for p, path in paths.items() if second.version in path} == {0, 4, 9}
    assert {p for p, path in paths.items() if first.version in path} == {-1, 1, 2, 3}
    want = {i: f"n{i}" for i in range(50)} | {3: "new", 47: "other", 99: "add", None: "null key"}
    assert content(read_keyed(spark, t)) == want
    assert content(read_keyed(spark, t, first.version)) == {i: f"n{i}" for i in range(50)} | {None: "null key"}
    assert not [n for n in list_children(spark, t.base) if n.startswith("_load-")]


def test_the_join_reads_keys_and_digests_of_near_parts_only(spark, tmp_path, monkeypatch):
    t = table(tmp_path)
    load_incremental(rows(spark, *[(i, f"n{i}") for i in range(50)]), t)
    read, original = [], incremental._stored

    def watched(session, keyed, paths):
        read.append([p.rsplit("=")[-1] for p in paths])
        return original(session, keyed, paths)

    monkeypatch.setattr(incremental, "_stored", watched)
    load_incremental(rows(spark, (3, "new"), (12, "n12")), t)
    assert read == [["0", "1"], ["0"]]  # compared, rewritten
    current = original(spark, t, list(part_paths(spark, t).values()))
    plan = detect_changes(current, rows(spark, (1, "x")), t.keys)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<id:bigint,__digest:bigint>" in plan


def test_unchanged_load_publishes_nothing(spark, tmp_path):
    t = table(tmp_path, ignored=("at",))
    load_incremental(rows(spark, (1, "a"), (2, "b")), t)
    again = load_incremental(rows(spark, (1, "a"), (2, "b")).withColumn("at", F.localtimestamp()), t)
    assert again.version is None and again.unchanged == 2 and again.parts == () and again.rows == 2
    assert len(incremental.committed_versions(spark, t.base)) == 1
    nothing = load_incremental(rows(spark, (1, "a")).filter("false"), t)
    assert nothing.version is None and nothing.rows == 0


def test_first_load_may_be_empty(spark, tmp_path):
    t = table(tmp_path)
    with pytest.raises(FileNotFoundError):
        read_keyed(spark, t)
    assert load_incremental(rows(spark, (1, "a")).filter("false"), t).version is not None
    assert read_keyed(spark, t).count() == 0
    load_incremental(rows(spark, (1, "a")), t)
    assert content(read_keyed(spark, t)) == {1: "a"}


def test_full_refresh_ends_the_look_back(spark, tmp_path):
    t = table(tmp_path)
    load_incremental(rows(spark, (1, "a"), (25, "b")), t)
    name, count = refresh_keyed(rows(spark, (1, "c"), (2, "d")), t)
    assert count == 2 and content(read_keyed(spark, t)) == {1: "c", 2: "d"}
    refresh_keyed(rows(spark, (1, "c")).filter("false"), t)
    assert read_keyed(spark, t).count() == 0 and content(read_keyed(spark, t, name)) == {1: "c", 2: "d"}


def test_failed_load_keeps_the_table(spark, tmp_path):
    t = table(tmp_path)
    load_incremental(rows(spark, (1, "a"), (2, "b")), t)
    bad = rows(spark, (1, "x"), (5, "y")).withColumn("name", F.when(F.col("id") == 5, F.raise_error(F.lit("boom"))).otherwise(F.col("name")))
    with pytest.raises(Exception, match="boom"):
        load_incremental(bad, t)
    with pytest.raises(Exception, match="share the key"):
        load_incremental(rows(spark, (1, "x"), (1, "y")), t)
    assert content(read_keyed(spark, t)) == {1: "a", 2: "b"}
    assert not [n for n in list_children(spark, t.base) if n.startswith("_load-")]


def test_a_load_killed_half_way_is_never_read(spark, tmp_path, monkeypatch):
    t = table(tmp_path)
    load_incremental(rows(spark, (1, "a"), (2, "b")), t)
    spark.createDataFrame([(1, "half")], "id long, name string").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{t.base}/v=000000000000002-dead/__layout=load-{t.definition}/__part=0")
    assert content(read_keyed(spark, t)) == {1: "a", 2: "b"}
    assert load_incremental(rows(spark, (2, "c")), t).version.startswith("v=000000000000003")
    assert content(read_keyed(spark, t)) == {1: "a", 2: "c"}


def test_a_load_in_between_is_noticed(spark, tmp_path, monkeypatch):
    t = table(tmp_path)
    load_incremental(rows(spark, (1, "a")), t)
    original = incremental._write_version

    def raced(frame, keyed, kind):
        monkeypatch.setattr(incremental, "_write_version", original)
        load_incremental(rows(spark, (2, "theirs")), t)
        return original(frame, keyed, kind)

    monkeypatch.setattr(incremental, "_write_version", raced)
    with pytest.raises(RuntimeError, match="withdrawn"):
        load_incremental(rows(spark, (1, "mine")), t)
    assert content(read_keyed(spark, t)) == {1: "a", 2: "theirs"}
    load_incremental(rows(spark, (1, "mine")), t)
    assert content(read_keyed(spark, t)) == {1: "mine", 2: "theirs"}


def test_other_definition_raises(spark, tmp_path):
    load_incremental(rows(spark, (1, "a")), table(tmp_path))
    with pytest.raises(ValueError, match="another key or partitioning"):
        read_keyed(spark, table(tmp_path, part_by="id DIV 20"))
    with pytest.raises(ValueError, match="not columns"):
        KeyedTable("x", SCHEMA, ("nope",), "1")


def test_vacuum_keeps_what_the_table_needs(spark, tmp_path):
    t = table(tmp_path)
    one = load_incremental(rows(spark, (1, "a"), (11, "b")), t).version
    two = load_incremental(rows(spark, (1, "c")), t).version
    three = load_incremental(rows(spark, (1, "d")), t).version
    assert vacuum_keyed(spark, t, older_than=3600) == []
    assert vacuum_keyed(spark, t, older_than=-1) == [two]
    assert content(read_keyed(spark, t)) == {1: "d", 11: "b"}
    four, _ = refresh_keyed(rows(spark, (1, "e")), t)
    assert sorted(vacuum_keyed(spark, t, older_than=-1)) == sorted([one, three])
    assert content(read_keyed(spark, t)) == {1: "e"} and four


def test_many_random_loads_equal_a_dictionary(spark, tmp_path):
    rng, t, want = random.Random(11), table(tmp_path, part_by="pmod(xxhash64(id), 5)"), {}
    for step in range(4):
        feed = {rng.randrange(60): f"{step}-{rng.randrange(3)}" for _ in range(25)}
        result = load_incremental(rows(spark, *feed.items()), t)
        assert result.inserted == len(feed.keys() - want.keys())
        assert result.updated == sum(want[k] != v for k, v in feed.items() if k in want)
        want |= feed
        assert content(read_keyed(spark, t)) == want


def test_read_published_as_of(spark, tmp_path):
    base = str(tmp_path / "p")
    schema = T.StructType([T.StructField("id", T.LongType())])
    first, _ = publish(spark.range(2), base, schema)
    publish(spark.range(3), base, schema)
    assert read_published(spark, base, schema).count() == 3
    assert read_published(spark, base, schema, first.rsplit("/", 1)[1]).count() == 2
    with pytest.raises(FileNotFoundError):
        read_published(spark, base, schema, "v=7")


def test_only_versions_have_a_folder_for_each_part(spark, tmp_path, monkeypatch):
    t, kept = table(tmp_path), []
    monkeypatch.setattr(incremental, "delete_path", lambda session, path: kept.append(path))
    load_incremental(rows(spark, *[(i, f"n{i}") for i in range(50)]), t)
    load_incremental(rows(spark, *[(i, "new") for i in range(0, 100, 2)]), t)
    assert len(kept) == 2
    for work in kept:
        for name in list_children(spark, work):
            assert not [n for n in list_children(spark, f"{work}/{name}") if "=" in n]
    assert len(part_paths(spark, t)) == 10
