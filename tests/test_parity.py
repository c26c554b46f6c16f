"""Every registered query with a SQL twin gives the same rows as the twin on DuckDB."""

import math
from datetime import datetime

import duckdb
import pytest

import __spark_entry__ as entry
from shoplens.plans import queries as registry

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
# A fit takes long and its results are only comparable with themselves
SLOW = {name for name in registry.QUERIES if name.startswith("als_")}


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{small}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value.isoformat() if isinstance(value, datetime) else value


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, duck, small, name):
    df = entry.queries()[name](spark, small)
    columns = sorted(df.columns)
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = sorted(repr([plain(r[i]) for i in places]) for r in cursor.fetchall())
    got = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    assert got == expected
    assert got, "an empty result proves nothing"


def test_every_sql_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    without = set(registry.QUERIES) - set(registry.ORACLES)
    assert without == {name for name in SLOW if not name.endswith(("_invariants", "_facts"))}


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
