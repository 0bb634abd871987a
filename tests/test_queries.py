"""Every registered binding against its SQL on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from funnelspark.plans import bindings, campaign_bindings, feed_bindings, record_bindings, source_bindings, system_bindings  # noqa: F401

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(df):
    columns = sorted(df.columns)
    return columns, sorted(tuple("-" if v is None or pd.isna(v) else f"{v:.6g}" if isinstance(v, float) else str(v) for v in row) for row in df[columns].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(bindings.QUERIES))
def test_query(spark, duck, name):
    got = bindings.QUERIES[name](spark, FOLDER).toPandas()
    assert len(got)
    if name in bindings.SQL:
        assert plain(got) == plain(duck.sql(bindings.SQL[name]).df())
