"""Every registered driver query against its DuckDB oracle on the smallest tables."""

import datetime as dt
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from freshcat.plans.driver_queries import QUERIES
from freshcat.plans.oracle_sql import ORACLE_SQL
from tests.conftest import SF_SMALL

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _norm(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["pickup", "music_id", "music_name"]
    assert df.count() >= 0


DUCK_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
              "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = df.columns
    described = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {entry.oracle_sql()[name]}").fetchall()}
    for field in df.schema.fields:
        spark_type = field.dataType.simpleString()
        assert DUCK_TYPES.get(spark_type, spark_type) == described[field.name], field.name
    got = Counter(tuple(_norm(v) for v in r) for r in df.collect())
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    want = Counter(tuple(_norm(r[i]) for i in idx) for r in res.fetchall())
    assert got == want
