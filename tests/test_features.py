"""Agglomerative clusters, topic keywords' parts, models in batches and maintained totals against plain versions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loomcast.functions import models as M
from loomcast.operators import features as A
from loomcast.streaming import maintained as K


def plain_ward(vecs, clusters):
    groups = [[i] for i in range(len(vecs))]

    def cost(a, b):
        x, y = vecs[a].mean(axis=0), vecs[b].mean(axis=0)
        return len(a) * len(b) / (len(a) + len(b)) * float(((x - y) ** 2).sum())

    while len(groups) > clusters:
        _, i, j = min((cost(a, b), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j)
        groups[i] += groups.pop(j)
    return {frozenset(g) for g in groups}


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    return np.concatenate([rng.normal(size=8) * 2 + rng.normal(size=(25, 8)) for _ in range(4)])


def partition(found):
    out = {}
    for i, c in found.items():
        out.setdefault(c, set()).add(i)
    return {frozenset(g) for c, g in out.items() if c != -1}


def test_each_row_its_own_feature_equals_plain_linkage(spark, vectors):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(900, None)]
    want = plain_ward(vectors, 4)
    for parts in (1, 16):
        found = dict(map(tuple, A.agglomerative(spark.createDataFrame(rows, "vec_id long, e array<double>").repartition(parts), 4).collect()))
        assert partition(found) == want and found[900] == -1 and found[0] == 0


def test_cells_features_find_planted_groups_at_any_partitions(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(5, 16)) * 3
    rows = [(i, (centres[i % 5] + rng.normal(size=16) * 0.3).tolist()) for i in range(1000)]
    found = [dict(map(tuple, A.agglomerative(spark.createDataFrame(rows, "vec_id long, e array<double>").repartition(p), 5, features=60).collect())) for p in (1, 9)]
    assert found[0] == found[1]
    assert partition(found[0]) == {frozenset(range(g, 1000, 5)) for g in range(5)}


def test_features_add_up(spark, vectors):
    df = spark.createDataFrame([(i % 3, v.tolist()) for i, v in enumerate(vectors)], "cell long, e array<double>")
    for r in A.cell_features(df, "cell").collect():
        part = vectors[r.cell :: 3]
        assert r.n == len(part) and np.allclose(r.sums, part.sum(axis=0)) and np.isclose(r.squares, (part**2).sum())


def test_models_are_loaded_once_and_called_in_batches():
    loads, calls = [], []

    def load():
        loads.append(1)

        def model(texts):
            calls.append(list(texts))
            if len(calls) == 2:
                raise OSError("not now")
            return [t.upper() for t in texts]

        return model

    series = [pd.Series(["a", "b", "a", None, "c"]), pd.Series([None]), pd.Series(["d"])]
    out = [list(s) for s in M.called(iter(series), "test-upper", load, 2, 1, 3, 0.0)]
    again = [list(s) for s in M.called(iter(series[:1]), "test-upper", load, 2, 1, 3, 0.0)]
    assert out == [["A", "B", "A", None, "C"], [None], ["D"]] and again == [out[0]]
    assert len(loads) == 1 and calls[:4] == [["a", "b"], ["c"], ["c"], ["d"]]
    with pytest.raises(ValueError):
        list(M.called(iter([pd.Series(["x"])]), "test-short", lambda: lambda texts: [], 2, 1, 1, 0.0))


def test_a_model_column_is_worked_out_once(spark):
    shout = M.batched("test-shout", lambda: lambda texts: [t + "!" for t in texts], "string", 3)
    df = spark.createDataFrame([("a",), ("b",), (None,)], "t string").withColumn("x", shout(F.col("t")))
    used = df.where("x is not null").select("x", F.length("x").alias("n"))
    assert used._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert sorted(map(tuple, used.collect())) == [("a!", 2), ("b!", 2)]


def test_maintained_totals_equal_a_recompute(spark, tmp_path):
    rng = np.random.default_rng(8)
    live, seen, path = {}, 0, str(tmp_path)
    write = K.maintained_sink(path, "k", "u", "t", "v", buckets=4)
    for number in range(4):
        change = []
        for i in [*rng.choice(list(live), size=min(len(live), 12), replace=False).tolist()] if live else []:
            change.append((*live[i], -1))
            if rng.random() < 0.6:  # an update, perhaps to another key
                live[i] = (int(rng.integers(0, 9)), *live[i][1:3], int(rng.integers(0, 100)))
                change.append((*live[i], 1))
            else:
                del live[i]
        for _ in range(20 if number < 3 else 0):
            seen += 1
            live[seen] = (int(rng.integers(0, 9)), int(rng.integers(0, 5)), int(rng.integers(0, 50)), int(rng.integers(0, 100)))
            change.append((*live[seen], 1))
        df = spark.createDataFrame(change, "k long, u long, t long, v long, sign int").withColumn("v", F.col("v").cast("decimal(12,2)"))
        for _ in range(1 + (number == 1)):  # a batch may be run again
            write(df, number)
        want = set()
        for k in {r[0] for r in live.values()}:
            rows = [r for r in live.values() if r[0] == k]
            last = max((t, u) for _, u, t, _ in rows)
            want.add((k, len(rows), sum(r[3] for r in rows), len({r[1] for r in rows}), last[1], last[0]))
        got = {(r.k, r.n, int(r.total), r.units, r.last_unit, r.last_at) for r in K.at_state(spark, path, "totals", number).collect()}
        assert got == want, number
