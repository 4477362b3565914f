"""Every registered query against its SQL oracle (DuckDB) on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from churnlens.plans.catalog import ORACLE_SQL, QUERIES
from tools.check_oracle import TABLES, digest

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_DIR}/{t}.parquet"
        if Path(p).exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_DIR)
    s_rows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(ORACLE_SQL[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(sdf.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(sdf.columns, s_rows)[0] == digest(d_cols, d_rows)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["contract_type", "count", "churn_rate"]
    assert df.count() >= 0


SPARK_TO_DUCKDB = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_types_match_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_DIR)
    rel = duck.sql(ORACLE_SQL[name])
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for field in sdf.schema.fields:
        spark_type = field.dataType.simpleString()
        expected = SPARK_TO_DUCKDB.get(spark_type, spark_type.upper())
        assert duck_types[field.name] == expected, f"{field.name}: {spark_type} vs {duck_types[field.name]}"
