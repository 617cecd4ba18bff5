"""Pairs of labels are found between all rows, whichever ids they have."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from loomcast.operators import search as Q
from loomcast.plans.joining import conflict_pairs


def test_rows_of_any_id_conflict(spark, tmp_path):
    rows = [(1, [1.0, 0.1], 5), (2, [1.0, 0.2], 3), (3, [-1.0, 0.0], 4), (21, [-1.0, 0.1], 5), (20, [0.0, -1.0], 9), (7, [0.0, -1.0], 9), (8, [1.0, 0.0], None), (9, None, 3)]
    pq.write_table(pa.table({"vec_id": pa.array([r[0] for r in rows], pa.int64()), "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32())), "label": pa.array([r[2] for r in rows], pa.int32())}), tmp_path / "embeddings.parquet")
    got = [tuple(r) for r in conflict_pairs(spark, str(tmp_path)).collect()]
    assert sorted(got) == [(3, 5), (4, 5)]  # before: none, as no id but 20 was asked


def test_parts_that_meet_once(spark, monkeypatch):
    monkeypatch.setattr(Q, "TILE_STEP", 500)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 12))
    label = rng.integers(0, 60, size=400)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    sims = np.round(u @ u.T, 6)
    for over in (0.3, 0.75):
        want = {(min(label[i], label[j]), max(label[i], label[j])) for i, j in np.argwhere(sims > over) if label[i] != label[j]}
        for keys in (1 << 16, 100):
            monkeypatch.setattr(Q, "KEYS_AT_ONCE", keys)
            df = spark.createDataFrame([(i, x[i].tolist(), int(label[i])) for i in range(400)], "vec_id long, e array<double>, label int")
            asked = df.selectExpr("vec_id as q", "e as qe", "label as l")
            found = Q.tiled(df, asked, Q.some_pair(over, "l", "label", differ=True), "vec_id", "e", "q", "qe", most=64, once=True).collect()
            assert {(min(r.l, r.label), max(r.l, r.label)) for r in found} == want
            assert all(r.sim > over and r.l != r.label for r in found)


def test_settled_keys_are_not_compared_again(monkeypatch):
    monkeypatch.setattr(Q, "TILE_STEP", 2000)
    x = np.ones((1000, 4)) / 2
    columns = {"l": np.arange(1000) % 2}
    t = Q.Tile(pa.table({"q": range(1000), **columns}), pa.table({"r": range(1000), "label": columns["l"]}), x, x, 6)
    cells = []
    monkeypatch.setattr(t, "steps", lambda i, j, inner=t.steps: (cells.append(s.size) or (q, s) for q, s in inner(i, j)))
    i, j, v = Q.some_pair(0.3, "l", "label", differ=True)(t)
    assert len(i) == 1 and sum(cells) <= 2000  # of a million
