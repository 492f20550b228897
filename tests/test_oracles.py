"""Every query with an oracle gives DuckDB's rows on the smallest tables."""

import os

import duckdb
import pytest

from methylspark import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows(columns, values):
    return sorted(tuple("~" if v is None else v.isoformat() if hasattr(v, "isoformat") else repr(v) for v in r) for r in values)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_oracle(spark, duck, name):
    want = duck.sql(catalog.ORACLES[name])
    columns = sorted(want.columns)
    df = catalog.QUERIES[name](spark, SF)
    assert sorted(df.columns) == columns
    got = df.select(*[f"`{c}`" for c in columns]).collect()
    assert rows(columns, map(tuple, got)) == rows(columns, want.select(", ".join(f'"{c}"' for c in columns)).fetchall())


def test_every_query_runs_without_oracle(spark):
    for name in sorted(catalog.QUERIES.keys() - catalog.ORACLES.keys()):
        assert catalog.QUERIES[name](spark, SF).count() > 0
