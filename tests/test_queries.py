"""Every registered query against its SQL in DuckDB, over the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from weftline.plans import registry
from weftline.sources import derived as D

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows(df: pd.DataFrame) -> list:
    def plain(x):
        if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and x != x):
            return None
        return round(float(x), 6) if isinstance(x, float) else str(x)

    df = df[sorted(df.columns)].astype(object)
    return sorted((tuple(map(plain, r)) for r in df.itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_equals_sql(spark, duck, name):
    ours, theirs = registry.QUERIES[name](spark, SF).toPandas(), duck.sql(registry.ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0


def test_every_line_has_an_index_map(spark):
    lines = D.lines(spark, SF).select("doc_id", "line_no")
    assert lines.exceptAll(registry.QUERIES["map_indices"](spark, SF).select("doc_id", "line_no")).count() == 0
