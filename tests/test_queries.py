"""Every registered query against its SQL statement on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import siltstone.queries  # noqa: F401
from siltstone.queries.registry import ORACLES, QUERIES

SF_DIR = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.skipif(not SF_DIR.exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, oracle, name):
    df = QUERIES[name](spark, str(SF_DIR))
    columns = sorted(df.columns)
    got = sorted(tuple(str(row[c]) for c in columns) for row in df.collect())
    result = oracle.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(tuple(str(row[i]) for i in at) for row in result.fetchall())
    assert got
