"""Every registered core query on the smallest tables; those with SQL give the same rows as DuckDB."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from gristmill import plans

FOLDER = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in FOLDER.glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path / '*.parquet' if path.is_dir() else path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if value != value else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    return value


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query(spark, duck, name):
    df = plans.queries()[name](spark, str(FOLDER))
    columns = sorted(df.columns)
    got = Counter(repr([plain(r[c]) for c in columns]) for r in df.collect())
    if name not in plans.oracles():
        return
    found = duck.execute(plans.oracles()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == Counter(repr([plain(r[i]) for i in at]) for r in found.fetchall())


def test_every_oracle_has_a_query():
    assert set(plans.oracles()) <= set(plans.queries())
