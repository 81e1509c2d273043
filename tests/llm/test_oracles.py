"""Queries of the subpackage that SQL can express give the same rows as DuckDB."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from gristmill.llm.queries import ORACLES, QUERIES

FOLDER = Path("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in FOLDER.glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path / '*.parquet' if path.is_dir() else path}')")
    df = QUERIES[name](spark, str(FOLDER))
    columns = sorted(df.columns)
    found = con.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = Counter(tuple(r[i] for i in at) for r in found.fetchall())
    assert Counter(tuple(r[c] for c in columns) for r in df.collect()) == want and want
