"""Every registered query against its DuckDB oracle on sf0.001
(the driver runs the same comparison at sf0.01)."""
import datetime as dt
import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from enrichkit.sources.testdata import TABLES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return str(int(v)) if v.is_integer() else repr(round(v, 6))
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat() + "T00:00:00"
    try:
        if pd.isna(v):
            return "∅"
    except (TypeError, ValueError):
        pass
    return str(v)


def _rows(df):
    cols = sorted(df.columns)
    return cols, sorted("|".join(_norm(r[c]) for c in cols) for r in df.to_dict("records"))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "reference_id" in df.columns


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - set(entry.LLM_QUERIES)))
def test_query_matches_oracle(spark, con, name):
    got = _rows(entry.queries()[name](spark, SF).toPandas())
    want = _rows(con.sql(entry.oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
