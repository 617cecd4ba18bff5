"""The inverted-file search meets rows in tiles: no row is made for each pair, and all cells visited is the exact search."""

import numpy as np

from loomcast.operators import ann as N


def test_cells_meet_in_tiles(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 8))
    df = spark.createDataFrame([(i, v.tolist(), i % 2) for i, v in enumerate(x)] + [(600, None, 0)], "vec_id long, e array<double>, label int")
    cells = N.fit_cells(df, cells=9)
    asked = df.where("vec_id % 20 = 0 AND e IS NOT NULL").selectExpr("vec_id AS query_id", "e AS qe")
    found = N.search(N.build(df, cells, keys=["label"]), asked, cells, 4, visit=9, keys=["label"])
    assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().optimizedPlan().toString()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = set()
    for q in range(0, 600, 20):
        sims = np.round(u @ u[q], 6)
        for label in (0, 1):
            ids = sorted(range(label, 600, 2), key=lambda i: (-sims[i], i))[:4]
            want |= {(q, label, i, round(float(sims[i]), 6)) for i in ids}
    assert {(r.query_id, r.label, r.id, r.sim) for r in found.collect()} == want
