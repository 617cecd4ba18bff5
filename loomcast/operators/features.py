"""Agglomerative clusters by way of mergeable features: counts, sums and sums of squares of small cells of rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.operators.ann import fit_cells
from loomcast.operators.reliable import cut

#: Features that one task links; more rows than that are put into as many cells first.
FEATURES = 1000


def cell_features(rows: DataFrame, cell: str, vector: str = "e") -> DataFrame:
    """(cell, n, sums, squares) of rows (cell, vector): what a cell's rows come to; features of parts add up to that of the whole.

    A partial sum for each task, cell and dimension is shuffled.
    """
    cells = rows.select(cell, F.posexplode(vector).alias("i", "x")).groupBy(cell, "i").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"))
    held = cells.groupBy(cell).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("i", "s"))).alias("a"), F.sum("q").alias("squares"))
    return held.select(cell, "n", F.col("a.s").alias("sums"), "squares")


def ward(counts: np.ndarray, sums: np.ndarray, clusters: int) -> np.ndarray:
    """Cluster number of each feature: the two whose union adds least to the squared distances from the means are merged, again and again.

    Equal costs are taken by the features' order; numbers follow the first feature of each cluster.
    """
    n, total, label = counts.astype(float), sums.astype(float).copy(), np.arange(len(counts))
    mean = total / n[:, None]
    cost = n[:, None] * n[None] / (n[:, None] + n[None]) * np.maximum(((mean[:, None] - mean[None]) ** 2).sum(axis=2), 0) if len(n) <= 200 else _costs(n, mean)
    np.fill_diagonal(cost, np.inf)
    alive = len(n)
    while alive > max(1, clusters):
        a, b = sorted(np.unravel_index(int(np.argmin(cost)), cost.shape))
        n[a], total[a], label[label == b] = n[a] + n[b], total[a] + total[b], a
        cost[b], cost[:, b] = np.inf, np.inf
        live = np.isfinite(cost[a]) | (np.arange(len(n)) == a)
        row = n[a] * n / (n[a] + n) * ((total / n[:, None] - total[a] / n[a]) ** 2).sum(axis=1)
        row[~live], row[a] = np.inf, np.inf
        cost[a], cost[:, a] = row, row
        alive -= 1
    return np.unique(label, return_inverse=True)[1]


def _costs(n: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """ward's costs without a cube of differences."""
    square = (mean**2).sum(axis=1)
    return n[:, None] * n[None] / (n[:, None] + n[None]) * np.maximum(square[:, None] + square[None] - 2 * mean @ mean.T, 0)


def agglomerative(vectors: DataFrame, clusters: int, features: int = FEATURES, vec_id: str = "vec_id", vector: str = "e") -> DataFrame:
    """(vec_id, cluster): Ward linkage down to `clusters`, numbered by their least cell; rows without a vector are -1.

    Up to `features` rows are each linked as they are; more are put into so many cells
    around centroids (of a bounded sample, in an order by hash), whose features are linked,
    a bounded few in one task. The result doesn't depend on the input's partitions.
    """
    rows = vectors.where(F.col(vector).isNotNull()).select(F.col(vec_id).alias("id"), F.col(vector).alias("x"))
    if rows.limit(features + 1).count() <= features:
        placed = rows.withColumn("cell", F.col("id").cast("string"))
    else:
        cells = fit_cells(rows, "id", "x", features)

        @F.pandas_udf("string")
        def nearest(x: pd.Series) -> pd.Series:
            unit = np.stack(x.to_numpy()).astype(float)
            unit /= np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-12)
            return pd.Series(cells.nearest(unit, 1)[:, 0].astype(str))

        placed = cut(rows.withColumn("cell", nearest("x")))

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("first", ignore_index=True)
        return pd.DataFrame({"cell": pdf["cell"], "cluster": ward(pdf["n"].to_numpy(), np.stack(pdf["sums"].to_numpy()), clusters)})

    sized = cell_features(placed, "cell", "x").join(placed.groupBy("cell").agg(F.min("id").alias("first")), "cell")
    linked = sized.select("cell", "n", "sums", "first", F.lit(0).alias("all")).groupBy("all").applyInPandas(link, "cell string, cluster int")
    found = placed.join(linked, "cell").select(F.col("id").alias(vec_id), "cluster")
    return vectors.select(vec_id).join(found, vec_id, "left").select(vec_id, F.coalesce("cluster", F.lit(-1)).alias("cluster"))
