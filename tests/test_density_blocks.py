"""Pointers and clusters of bounded number in one task, and others in rounds, come out the same."""

import random

from loomcast.operators import density as D


def jobs(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    found = set(map(tuple, run().collect()))
    spark.sparkContext.setJobGroup("tests", "tests")
    return found, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_followed(spark):
    df = spark.createDataFrame([(-i, -i - 1) for i in range(1, 300)] + [(i, -i * 3) for i in range(1, 50)], "node long, to long")
    one, few = jobs(spark, "one", lambda: D.followed(df))
    rounds, many = jobs(spark, "rounds", lambda: D.followed(df, 0))
    assert one == rounds and len(one) == 348 and {t for _, t in one} == {-300} and few < many


def test_chosen(spark):
    random.seed(4)
    rows = [(-1 - i, None if i < 2 else -1 - random.randrange(max(0, i - 6), i), str(random.randrange(10**20)), i != 0) for i in range(90)]
    df = spark.createDataFrame(rows, "c long, parent long, stability string, able boolean").withColumn("stability", D.F.col("stability").cast("decimal(38,0)"))
    one, few = jobs(spark, "chosen", lambda: D._chosen(df))
    rounds, many = jobs(spark, "chosen in rounds", lambda: D._chosen(df, 0))
    assert one == rounds and len(one) == 90 and few < many
