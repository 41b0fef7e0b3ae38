"""Every query against its SQL, on the same files."""

import datetime
import math

import pytest

from lumenmart.oracle import oracle_queries
from lumenmart.plans.registry import QUERIES, all_queries
from tests.conftest import SF

duckdb = pytest.importorskip("duckdb")
TABLES = ("customer", "events", "nation", "orders", "part", "region", "supplier")
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}
ORACLE = oracle_queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return v.isoformat() if isinstance(v, datetime.datetime) else repr(v)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    df = all_queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(v) for v in r) for r in df.select(*columns).collect())
    result = con.execute(ORACLE[name])
    types = {d[0]: str(d[1]) for d in result.description}
    order = [list(types).index(c) for c in columns]
    assert sorted(types) == columns
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    assert got == sorted(tuple(plain(r[i]) for i in order) for r in result.fetchall())
