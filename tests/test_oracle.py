"""Every registered query with SQL matches its DuckDB twin (sf0.001)."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        if f.endswith(".parquet"):
            c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return c


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0 and "text" in df.columns


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    assert canon(cols, rows) == canon(dcols, cur.fetchall())


def test_every_query_of_the_reference_has_an_oracle():
    from cuecards.plans.queries import QUERIES

    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())
