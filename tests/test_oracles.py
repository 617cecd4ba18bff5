"""Every query that has SQL, against DuckDB on the smallest tables."""

import math
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")

from __spark_entry__ import queries  # noqa: E402
from loomcast.plans import registry  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{DATA}/{name}')")
    return con


def cell(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    return f"{v:.5f}" if isinstance(v, float) else str(int(v)) if isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_matches_sql(spark, duck, name):
    df = queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted([cell(x) for x in r] for r in df.select(*[f"`{c}`" for c in columns]).collect())
    rel = duck.execute(registry.ORACLES[name])
    names = [c[0] for c in rel.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted([cell(row[i]) for i in at] for row in rel.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(queries())
