"""Every query with SQL against DuckDB at the smallest scale."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest

from millrace.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.execute(f"CREATE VIEW {t[:-8]} AS SELECT * FROM '{SF}/{t}'")
    return con


def rows(df):
    cols = sorted(df.columns)

    def norm(v):
        if pd.isna(v):
            return "~"
        v = v.item() if hasattr(v, "item") else v
        return f"{v:.6g}" if isinstance(v, float) else str(v)

    return cols, sorted(tuple(map(norm, r)) for r in df[cols].itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables here")
@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_matches_sql(spark, con, name):
    assert rows(catalogue.queries()[name](spark, SF).toPandas()) == rows(con.execute(catalogue.oracle_sql()[name]).df())
