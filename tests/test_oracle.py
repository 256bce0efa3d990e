"""Every query of the engine's own operators against its SQL in DuckDB, on the smallest tables."""

import glob
import math
import os

import pytest

from paracorpus import catalog

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)) or str(x) == "<NA>":
        return None
    if hasattr(x, "tolist"):
        x = x.tolist()
    return tuple(map(plain, x)) if isinstance(x, (list, tuple)) else round(x, 6) if isinstance(x, float) else x


def rows(df):
    return sorted((tuple(plain(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_sql(spark, db, name):
    got, want = catalog.queries()[name](spark, DATA).toPandas(), db.execute(catalog.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_runs(spark, name):
    assert catalog.queries()[name](spark, DATA).count() > 0
