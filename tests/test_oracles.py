"""Every core query that has SQL gives the same rows as DuckDB on the smallest tables; the others run."""

import math
from pathlib import Path

import duckdb
import pytest

from strandline.plans import queries

SLOW = {"ground_fuzzy"}


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return round(v, 9) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_rows_as_sql(spark, sf, duck, name):
    df = queries.QUERIES[name](spark, sf)
    got = sorted(repr(tuple(plain(r[c]) for c in sorted(df.columns))) for r in df.collect())
    cur = duck.execute(queries.SQL[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    at = [cols.index(c) for c in sorted(cols)]
    assert got == sorted(repr(tuple(plain(r[i]) for i in at)) for r in cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL) - SLOW))
def test_runs_without_sql(spark, sf, name):
    assert queries.QUERIES[name](spark, sf).collect() is not None


def test_entry_has_rows(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
