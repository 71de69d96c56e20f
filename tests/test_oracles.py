"""Every registered query with an oracle equals its DuckDB SQL (row count,
column names and order-insensitive values), like the driver's gate."""

import duckdb
import pytest

import __spark_entry__ as E
from propval.sources.tables import DRIVER_TABLES
from tools.check_oracle import rows_of

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf, con, name):
    df = E.queries()[name](spark, sf)
    scols = df.columns
    sdata = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    ddata = res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(sdata) == len(ddata)
    assert rows_of(scols, sdata) == rows_of(dcols, ddata)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(E.queries())
