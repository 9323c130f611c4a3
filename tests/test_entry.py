"""The driver contract: entry(), queries(), oracle_sql()."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402

SMALL = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="shared test tables not present")


@needs_data
def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["Date", "ProjectId", "NumberOfTransactions", "TotalVolumeUsd"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows)


@needs_data
@pytest.mark.parametrize("name", ["daily_volume", "dead_letters", "reject_counts", "usd_lookup",
                                  "price_last_wins", "unknown_currency"])
def test_query_matches_oracle_on_small_tables(spark, name):
    con = duckdb.connect()
    for t in ("events", "lineitem", "orders", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SMALL)
    res = con.execute(E.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(res.fetchall(), d_cols)
