"""Approximate vector search by an inverted file: cells around centroids, of which a query visits the nearest few."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.functions.vectors import normalised
from loomcast.operators.search import best_rows, tiled
from loomcast.operators.windows import top_per_group

#: At most so many rows are read to place the centroids, the first in an order by a hash of their ids; every row is indexed.
SAMPLE = 20_000
CELLS, ROUNDS, SEED = 64, 12, 42


@dataclass(frozen=True)
class Cells:
    """Unit centroids; what is shipped to tasks is bounded by their number."""

    centroids: np.ndarray

    def nearest(self, unit: np.ndarray, n: int) -> np.ndarray:
        """The n nearest cells of each row, the nearest first."""
        sims = unit @ self.centroids.T
        return np.argsort(-sims, axis=1, kind="stable")[:, : min(n, len(self.centroids))]


def fit_cells(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "e", cells: int = CELLS, sample: int = SAMPLE) -> Cells:
    """Spherical k-means on a bounded sample of rows."""
    picked = vectors.where(F.col(vector).isNotNull()).orderBy(F.xxhash64(vec_id), vec_id).limit(sample).select(normalised(F.col(vector)).alias("x"))
    rows = np.array([r.x for r in picked.collect()], float)
    if not len(rows):
        return Cells(np.zeros((0, 0)))
    rng = np.random.default_rng(SEED)
    centroids = rows[rng.permutation(len(rows))[:cells]]
    for _ in range(ROUNDS):
        near = (rows @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, rows)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(size > 0, sums / np.maximum(size, 1e-12), centroids)
    return Cells(centroids)


def _with_cells(rows: DataFrame, cells: Cells, n: int) -> DataFrame:
    """rows (id, x, ...) with an array of each row's n nearest cells."""
    at, kinds = rows.columns.index("x"), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = np.asarray(batch.column(at).flatten().to_numpy(zero_copy_only=False), float).reshape(batch.num_rows, -1)
            near = cells.nearest(unit, n) if batch.num_rows else np.zeros((0, 0), int)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.tolist(), pa.list_(pa.int32()))], names=[*batch.schema.names, "cells"])

    return rows.mapInArrow(run, f"{kinds}, cells array<int>")


def build(vectors: DataFrame, cells: Cells, vec_id: str = "vec_id", vector: str = "e", keys: Sequence[str] = ()) -> DataFrame:
    """The index: (cell, id, x, keys), a row for every row with a vector; write it partitioned by cell to keep it."""
    rows = vectors.where(F.col(vector).isNotNull()).select(F.col(vec_id).alias("id"), normalised(F.col(vector)).alias("x"), *keys)
    return _with_cells(rows, cells, 1).select(F.col("cells")[0].alias("cell"), "id", "x", *keys)


def search(index: DataFrame, queries: DataFrame, cells: Cells, k: int, visit: int = 12, query_id: str = "query_id", query_vector: str = "qe", keys: Sequence[str] = ()) -> DataFrame:
    """(query_id, keys, id, sim): the k most similar rows in the `visit` cells nearest to each query, for each of keys if given.

    Queries and rows meet by cell, in tiles as in the exact search: quick similarities
    choose, what may count is worked out exactly, and k rows a query leave a tile.
    """
    asked = queries.where(F.col(query_vector).isNotNull()).select(F.col(query_id).alias("q"), normalised(F.col(query_vector)).alias("x"))
    asked = _with_cells(asked, cells, visit).select("q", F.col("x").alias("y"), F.explode("cells").alias("cell"))
    met = tiled(index.select("cell", "id", "x", *keys), asked, best_rows(k, keys), "id", "x", "q", "y", block="cell", few=(1, 1))
    met = met.select(F.col("q").alias(query_id), *keys, "id", "sim")
    return top_per_group(met, [query_id, *keys], [F.col("sim").desc(), F.col("id")], k)


def near_graph(vectors: DataFrame, k: int, vec_id: str = "vec_id", vector: str = "e", visit: int = 16) -> DataFrame:
    """(a, b, sim): about the k nearest others of every row, those met in the cells nearest to it."""
    cells = fit_cells(vectors, vec_id, vector)
    rows = vectors.select(F.col(vec_id).alias("a"), F.col(vector).alias("qe"))
    found = search(build(vectors, cells, vec_id, vector), rows, cells, k + 1, visit, query_id="a")  # itself too
    return top_per_group(found.where(F.col("a") != F.col("id")), ["a"], [F.col("sim").desc(), F.col("id")], k).select("a", F.col("id").alias("b"), "sim")
