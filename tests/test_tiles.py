"""Vector search in tiles against plain numpy."""

import contextlib
import io

import numpy as np
import pytest

from loomcast.operators import search as Q


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(2300, 6)), 3)
    x[100:400] = x[7]  # many equal similarities
    labels = rng.integers(0, 3, len(x))
    rows = [(i, x[i].tolist() if i % 97 else None, None if i % 50 == 3 else int(labels[i])) for i in range(len(x))]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame(rows, "vec_id long, e array<double>, label int").repartition(5).cache()
    return df, rows, np.round(unit @ unit.T, 6)


def asked(df):
    return df.where("vec_id % 2 = 0").selectExpr("vec_id AS query_id", "e AS qe", "label AS l")


def plan(df) -> str:
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


def test_nearest(table):
    df, rows, sims = table
    whole = [r[0] for r in rows if r[1] is not None]
    found = Q.nearest(df, asked(df), 4)
    want = {(q, r, sims[q, r]) for q in whole if q % 2 == 0 for r in sorted(whole, key=lambda r: (-sims[q, r], r))[:4]}
    assert {tuple(r) for r in found.select("query_id", "vec_id", "sim").collect()} == want
    assert "CoGroup" in plan(found)  # blocks meet blocks; no row meets a query by itself


def test_nearest_of_each_key(table):
    df, rows, sims = table
    whole = [r for r in rows if r[1] is not None]
    want = set()
    for q in [r[0] for r in whole if r[0] % 2 == 0]:
        for label in (0, 1, 2, None):
            some = sorted((r[0] for r in whole if r[2] == label), key=lambda r: (-sims[q, r], r))[:2]
            want |= {(q, r, label, sims[q, r]) for r in some if sims[q, r] >= 0.5}
    found = Q.nearest(df, asked(df), 2, 0.5, keys=["label"]).select("query_id", "vec_id", "label", "sim")
    assert {tuple(r) for r in found.collect()} == want


def test_best_queries_counts_and_pairs(table):
    df, rows, sims = table
    whole = [r[0] for r in rows if r[1] is not None]
    queries = [q for q in whole if q % 2 == 0]
    tiles = lambda choose, value="sim": Q.tiled(df, asked(df), choose, "vec_id", "e", "query_id", "qe", value)
    best = {r.vec_id: r.m for r in tiles(Q.best_queries(0.3)).groupBy("vec_id").agg({"sim": "max"}).toDF("vec_id", "m").collect()}
    assert best == {r: sims[queries, r].max() for r in whole if sims[queries, r].max() >= 0.3}
    n = {r.query_id: r.n for r in tiles(Q.count_rows(0.6), "n").groupBy("query_id").agg({"n": "sum"}).toDF("query_id", "n").collect()}
    assert n == {q: int((sims[q, whole] >= 0.6).sum()) for q in queries if (sims[q, whole] >= 0.6).any()}
    pairs = {(r.l, r.label) for r in tiles(Q.some_pair(0.9, "l", "label")).collect()}
    assert pairs == {(rows[q][2], rows[r][2]) for q in queries for r in whole if sims[q, r] > 0.9}
