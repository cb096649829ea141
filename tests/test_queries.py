"""Every catalogue query against its SQL on the smallest tables, if they are there."""

import glob
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from ledgerloom.plans import builds, catalog, filings, reports  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def rows(frame):
    def text(v):
        if v is None or v is pd.NA or v != v:
            return None
        if isinstance(v, (int, float, np.number)) and not isinstance(v, bool):
            return f"{float(v):.4f}"
        return str(v)[:10] if hasattr(v, "year") else str(v)

    frame = frame[sorted(frame.columns)].astype(object)
    return sorted((tuple(map(text, r)) for r in frame.itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_same_as_sql(spark, con, name):
    got, want = catalog.QUERIES[name](spark, SF).toPandas(), con.sql(catalog.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
