"""Every query with an oracle equals its DuckDB SQL (sf0.001, whole tables)."""

import duckdb
import pytest

import __spark_entry__ as E
from check_oracles import rows_of
from playlens.sources.tables import TABLES, table_path

from .conftest import SF_SMALL

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    sc, sr = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(ORACLES[name])
    dc, dr = rows_of([d[0] for d in res.description], res.fetchall())
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns
