"""Every query that has SQL, against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

from quillon.plans import catalogue

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DIR):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{DIR}/{f}'")
    return c


def plain(df):
    def one(v):
        if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return None
        return round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    df = df[sorted(df.columns)]
    return sorted([tuple(one(v.item() if hasattr(v, "item") else v) for v in r) for r in df.itertuples(index=False)], key=str)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_query_equals_sql(spark, duck, name):
    got = catalogue.QUERIES[name](spark, DIR).toPandas()
    want = duck.execute(catalogue.ORACLE[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


def test_alignments_find_their_places(spark):
    assert catalogue.QUERIES["align_reads"](spark, DIR).where("nh = 1").count() > 0


def test_entry_has_rows(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())
