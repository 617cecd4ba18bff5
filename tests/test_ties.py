"""Rows equal in what decides keep the order that their query states."""

from loomcast.operators import ranges as R


def words(spark):
    rows = [(k, i, float(k % 3), k % 3 + 1.0) for k in range(40) for i in (9, 4, 7)]
    return spark.createDataFrame(rows, "key long, idx long, start double, end double").repartition(3, "idx")


def test_equal_windows_take_the_first(spark):
    got = R.best_in_windows(words(spark), "key", "start", "end", 20.0, ties=["idx"])
    assert {(r.key, r.idx) for r in got.collect()} == {(k, 4) for k in range(40)}


def test_equal_segments_keep_the_first(spark):
    got = R.drop_overlaps(words(spark), "key", ties=["idx"])
    assert {(r.key, r.idx) for r in got.collect()} == {(k, 4) for k in range(40)}
