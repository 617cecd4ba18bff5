"""A chunk plan as rows is the plan as an array."""

from pyspark.sql import functions as F

from loomcast.operators import ranges as R
from loomcast.plans import scalars


def test_rows_of_a_plan(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([None, -3.0, 0.0, 1.0, 299.5, 300.0, 302.9, 303.0, 600.0, 898.1, 5000.25])], "id long, t double")
    rows = {(r.id, r.i, r.start, r.end) for r in R.chunk_rows(df, "t", 300.0, 2.0).select("id", "i", "start", "end").collect()}
    plan = df.select("id", F.posexplode(R.chunk_plan(F.col("t"), 300.0, 2.0)).alias("i", "p")).select("id", "i", "p.start", "p.end")
    assert rows == set(map(tuple, plan.collect())) and len({r[0] for r in rows}) == 8


def test_plans_spread_over_tasks(spark, tmp_path):
    rows = [(i, 1, "O", 250000.0 + i, None, "x") for i in range(64)]
    orders = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string")
    orders.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    assert scalars.chunks(spark, str(tmp_path)).rdd.getNumPartitions() > 1
    assert scalars.chunks(spark, str(tmp_path)).agg(F.sum("n")).first()[0] == sum(1 + (250000 + i - 2 - 1) // 298 - ((250000 + i) % 298 in (3, 4)) for i in range(64))
