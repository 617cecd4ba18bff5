"""Tasks that group rows take in a bounded number of them, however many there are."""

import pytest
from pyspark.sql import functions as F

from loomcast.operators import joins, reliable
from loomcast.plans import aggregating


@pytest.fixture(autouse=True)
def few_rows_a_task(monkeypatch):
    monkeypatch.setattr(reliable, "ROWS_A_TASK", 100)


def test_pairs_are_dealt_by_their_number(spark):
    df = spark.range(4000).select((F.col("id") / 4).cast("long").alias("g"), (F.col("id") % 4 + F.col("id") % 3).alias("m"))
    df = df.unionByName(spark.sql("select cast(null as long) g, 1L m union all select 1L, null"))
    want = {}
    groups = {}
    for r in df.where("g is not null and m is not null").collect():
        groups.setdefault(r.g, set()).add(r.m)
    for members in groups.values():
        for a in members:
            for b in members:
                if a < b:
                    want[a, b] = want.get((a, b), 0) + 1
    out = joins.co_appearance(df, "g", "m")
    assert {(r.a, r.b): r.together for r in out.collect()} == want
    assert out.rdd.getNumPartitions() == 160


def test_regular_speakers_are_dealt_by_the_segments(spark, tmp_path):
    spark.range(3000).selectExpr("id div 3 l_orderkey", "id l_partkey", "id % 7 l_suppkey", "cast(id % 3 as int) l_linenumber", "1D l_quantity", "1D l_extendedprice", "0D l_discount", "0D l_tax", "'N' l_returnflag", "'F' l_linestatus", "timestamp'1998-01-01' l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(1000).selectExpr("id o_orderkey", "id % 11 o_custkey", "date'1998-01-01' o_orderdate", "1D o_totalprice", "'x' o_orderpriority", "'F' o_orderstatus").write.parquet(f"{tmp_path}/orders.parquet")
    out = aggregating.regular_speakers(spark, str(tmp_path))
    assert "REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(channel_id" in out._jdf.queryExecution().executedPlan().toString()
    got = {(r.channel_id, r.speaker_id): r.episodes for r in out.collect()}
    met = {}
    for i in range(3000):
        met.setdefault((i // 3 % 11, i % 7), set()).add(i // 3)
    assert got == {k: len(v) for k, v in met.items()}
