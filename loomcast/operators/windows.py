"""Ranking, runs and top-k per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcast.operators.reliable import cut


def top_per_group(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], k: int = 1) -> DataFrame:
    """The first k rows of each group; Spark keeps k rows a group and task before it shuffles."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= k).drop("__rank")


def top(df: DataFrame, order: Sequence[Column], k: int, offset: int = 0) -> DataFrame:
    """A page of the whole order; the order must be total."""
    out = df.orderBy(*order)
    return (out.offset(offset) if offset else out).limit(k)


def competition_rank(df: DataFrame, score: str, out: str = "rank") -> DataFrame:
    """1 + the number of rows with a higher score.

    Distinct scores are counted and range-partitioned; a rank is what the partitions above
    hold, one number each, and what lies above inside the partition. So no task sorts all.
    """
    steps = df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("__score")).agg(F.count(F.lit(1)).alias("__n"))
    ranged = cut(steps.repartitionByRange(F.col("__score").desc()).withColumn("__part", F.spark_partition_id()))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    base = ranged.groupBy("__part").agg(F.sum("__n").alias("__all")).select("__part", F.coalesce(F.sum("__all").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("__part").orderBy(F.col("__score").desc()).rowsBetween(Window.unboundedPreceding, -1)
    above = ranged.withColumn("__inside", F.coalesce(F.sum("__n").over(inside), F.lit(0))).join(base, "__part")
    return df.join(above.select("__score", (F.col("__base") + F.col("__inside") + 1).alias(out)), F.col(score) == F.col("__score"), "left").drop("__score")


def runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str = "run") -> DataFrame:
    """Adds out: 1, 2, ... for each run of equal values in order (nulls equal each other)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    new = F.when(F.row_number().over(w) == 1, 1).when(~F.col(value).eqNullSafe(F.lag(value).over(w)), 1).otherwise(0)
    return df.withColumn("__new", new).withColumn(out, F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def absorb_interruptions(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """A value between two equal others takes theirs; judged on the values before any change."""
    w = Window.partitionBy(*keys).orderBy(*order)
    before, after = F.lag(value).over(w), F.lead(value).over(w)
    return df.withColumns({"__b": before, "__a": after}).withColumn(value, F.when((F.col("__b") == F.col("__a")) & (F.col("__b") != F.col(value)), F.col("__b")).otherwise(F.col(value))).drop("__b", "__a")


def gap_groups(df: DataFrame, keys: Sequence[str], start: str, end: str, gap: float, out: str = "grp") -> DataFrame:
    """Adds out: a new group where a start lies at least gap after all earlier ends."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    seen = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(seen.isNull() | (F.col(start) - seen >= gap), 1).otherwise(0)
    return df.withColumn("__new", new).withColumn(out, F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def batches(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, out: str = "batch") -> DataFrame:
    return df.withColumn(out, F.floor((F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1) / size))


def smooth(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, half: int = 3, out: str = "smooth") -> DataFrame:
    """Mean over 2 * half + 1 places of the series, mirrored at its ends (the end value repeats)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    n, at = F.count(F.lit(1)).over(Window.partitionBy(*keys)), F.row_number().over(w)
    cells = F.collect_list(value).over(w.rowsBetween(-2 * half, 2 * half))
    numbered = df.withColumns({"__n": n, "__at": at, "__cells": cells}).withColumn("__first", F.greatest(F.lit(1), F.col("__at") - 2 * half))

    def mirrored(k: Column) -> Column:
        p = F.pmod(k - 1, 2 * F.col("__n"))
        return F.when(p < F.col("__n"), p + 1).otherwise(2 * F.col("__n") - p)

    spots = F.transform(F.sequence(F.lit(-half), F.lit(half)), lambda d: F.element_at("__cells", (mirrored(F.col("__at") + d) - F.col("__first") + 1).cast("int")))
    return numbered.withColumn(out, F.aggregate(spots, F.lit(0.0), lambda s, x: s + x) / (2 * half + 1)).drop("__n", "__at", "__cells", "__first")


def merge_contractions(df: DataFrame, keys: Sequence[str], order: Sequence[str], word: str) -> DataFrame:
    """(keys, at, word): a word takes up the next if that starts with an apostrophe; a word taken up takes none itself.

    at numbers the words that are left in order.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    head = F.when(F.col(word).startswith("'"), 0).otherwise(1)
    marked = df.withColumn("__head", F.sum(head).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    inside = F.row_number().over(Window.partitionBy(*keys, "__head").orderBy(*order)) - 1
    pairs = marked.withColumn("__pair", F.floor(inside / 2)).groupBy(*keys, "__head", "__pair").agg(F.array_sort(F.collect_list(F.struct(*order, word))).alias("__w"))
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("__head", "__pair"))
    return pairs.select(*keys, number.cast("long").alias("at"), F.array_join(F.col(f"__w.{word}"), "").alias(word))
