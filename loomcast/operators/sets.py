"""Set operations by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.operators.windows import top_per_group


def union_keep_best(frames: Sequence[DataFrame], key: str, score: str) -> DataFrame:
    """One row a key: that of the highest score; the earlier frame wins ties."""
    tagged = [f.withColumn("__from", F.lit(i)) for i, f in enumerate(frames)]
    whole = tagged[0]
    for f in tagged[1:]:
        whole = whole.unionByName(f)
    best = whole.groupBy(key).agg(F.min_by(F.struct(*frames[0].columns), F.struct((-F.col(score)).alias("s"), F.col("__from"))).alias("__row"))
    return best.select("__row.*")


def union_keep_first(frames: Sequence[DataFrame], keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row for each keys: the first by frame, then by order."""
    whole = frames[0].withColumn("__from", F.lit(0))
    for i, f in enumerate(frames[1:], 1):
        whole = whole.unionByName(f.withColumn("__from", F.lit(i)))
    return top_per_group(whole, list(keys), [F.col("__from"), *order]).drop("__from")


def matched_via(left: DataFrame, right: DataFrame, key: str, left_name: str, right_name: str) -> DataFrame:
    """(key, matched_via) of the union: one of the names, or both."""
    l, r = left.select(key).distinct().withColumn("__l", F.lit(1)), right.select(key).distinct().withColumn("__r", F.lit(1))  # noqa: E741
    name = F.when(F.col("__r").isNull(), left_name).when(F.col("__l").isNull(), right_name).otherwise("both")
    return l.join(r, key, "full").select(key, name.alias("matched_via"))


def merge_maps(left: Column, right: Column) -> Column:
    """Keys of both; left's values win."""
    return F.map_zip_with(left, right, lambda _, a, b: F.coalesce(a, b))


def merge_arrays(left: Column, right: Column) -> Column:
    return F.array_sort(F.array_union(F.coalesce(left, F.array()), F.coalesce(right, F.array())))
