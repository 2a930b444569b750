"""Every catalogue query equals its SQL statement run by DuckDB (sf0.001)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import duckdb  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402

import __spark_entry__ as E  # noqa: E402

from ledgerloom.plans import catalog  # noqa: E402

NAMES = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf_small}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_oracle():
    assert set(catalog.ORACLE_SQL) == set(catalog.QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, sf_small, name):
    df = E.queries()[name](spark, sf_small)
    got = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    cols, want = rel.columns, rel.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert digest(df.columns, got)[0] == digest(cols, want)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["year", "quarter", "orig_amt_usd", "balance_usd", "default_rate"]
