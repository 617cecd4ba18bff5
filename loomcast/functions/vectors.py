"""Vector functions over arrays of doubles, kept on the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPSILON = 1e-8


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))


def cosine(a: Column, b: Column, guard: float = EPSILON) -> Column:
    """Cosine similarity; guard is added to each norm, so that zero vectors give 0."""
    return dot(a, b) / ((norm(a) + guard) * (norm(b) + guard))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def normalised(a: Column) -> Column:
    """Unit vector; a zero vector stays. The length is bound to a lambda's variable, so that it is computed once."""
    return F.element_at(F.transform(F.array(norm(a)), lambda n: F.when(n > 0, F.transform(a, lambda x: x / n)).otherwise(a)), 1)


def mean_vectors(df: DataFrame, keys: list[str], vector: str = "e", weight: str | None = None, unit: bool = False) -> DataFrame:
    """(keys, vector): the mean vector of each group, weighted if a weight column is named.

    One partial sum a dimension, group and task is shuffled, whatever a group's size.
    """
    w = F.lit(1.0) if weight is None else F.col(weight)
    cells = df.where(F.col(vector).isNotNull()).select(*keys, w.alias("__w"), F.posexplode(vector).alias("__i", "__x"))
    sums = cells.groupBy(*keys, "__i").agg((F.sum(F.col("__x") * F.col("__w")) / F.sum("__w")).alias("__m"))
    out = sums.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("__i", "__m"))).alias("__a")).select(*keys, F.col("__a.__m").alias(vector))
    return out.withColumn(vector, normalised(F.col(vector))) if unit else out
