"""The driver contract: entry() runs; every registered query agrees with its
DuckDB oracle (row count, columns, order-insensitive value hash)."""

import os

import duckdb
import pytest

import __spark_entry__ as se
from conftest import SF_SMALL
from oracle_check import TABLES, table_hash
from trailfeat.plans import catalog, oracle_sql


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.count() > 0 and len(df.columns) == 72


def test_oracle_keys_subset_of_queries():
    assert set(se.oracle_sql()) <= set(se.queries())
    # every operator of the library has a SQL twin, but for trees that several features decide (tests/test_boosting.py);
    # the corpus operators are tested in tests/llm
    assert set(catalog.queries()) - set(oracle_sql.oracle_sql()) == {"gbt_train_predict_label", "sampled_train_predict"}
    assert set(oracle_sql.oracle_sql()) <= set(catalog.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("key", sorted(oracle_sql.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    df = se.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(se.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert table_hash(rows, df.columns) == table_hash(orows, ocols)
