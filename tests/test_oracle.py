"""Every registered plan against its SQL oracle (DuckDB) on the sf0.001 tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from strata.plans import ORACLE, QUERIES
from strata.sources.tables import DRIVER_TABLES

from conftest import SF_SMALL


def _norm(v):
    if v is None:
        return ("~",)
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["c_mktsegment", "o_orderpriority", "total_orders"]
    assert df.count() > 0


def test_every_plan_has_an_oracle_or_is_listed():
    missing = set(QUERIES) - set(ORACLE)
    assert missing == {"file_checksums"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_plan_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, srows) == _rows(ocols, orows)
