"""Registered queries: names, and those with SQL against DuckDB."""
import os
import re

import duckdb
import pytest
from enrichkit.llm.queries import ORACLES, QUERIES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def test_one_query_for_every_operator():
    assert sorted(int(re.fullmatch(r"op(\d+)_\w+", q)[1]) for q in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(ORACLES[name])
    cols = sorted(want.columns)
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == cols
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=key) == sorted(
        want.select(*[duckdb.ColumnExpression(c) for c in cols]).fetchall(), key=key)
