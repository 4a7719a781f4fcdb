"""Every registered query with an oracle equals DuckDB on the sf0.001 tables."""

import duckdb
import pytest

import __spark_entry__ as E
from check_oracle import digest
from conftest import SF_SMALL
from quill.session import TABLES

ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    orows = rel.fetchall()
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(rel.columns, orows)[0]


def test_entry_runs(spark):
    assert E.entry(spark).count() >= 0
