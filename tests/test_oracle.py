"""Every catalogued query against its DuckDB text, on the smallest testdata."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

from check_oracle import TABLES, digest  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from blobtally.plans.catalog import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(df.columns, s_rows)[0] == digest(d_cols, d_rows)[0]


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["file_id", "emptyPercent", "remainSize", "path", "deleted"]
    assert df.count() > 0
