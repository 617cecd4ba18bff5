"""Density clusters against a plain hierarchy, over planted groups."""

import numpy as np
import pytest

from loomcast.operators import density as D

SCALE = 10**6


def brute(ids, vecs, size, samples, k, single=False):
    """Cluster of each id; the graph is that of the k nearest rows."""
    unit = vecs / np.linalg.norm(vecs, axis=1, keepdims=True)
    sims = np.round(unit @ unit.T, 6)
    np.fill_diagonal(sims, -np.inf)
    near = [sorted((i for i in range(len(ids)) if i != r), key=lambda i: (-sims[r, i], ids[i]))[:k] for r in range(len(ids))]
    dist = np.sqrt(np.maximum(0, 2 - 2 * np.where(np.isfinite(sims), sims, 0)))
    core = [sorted(dist[r, near[r]])[min(samples, len(near[r])) - 1] for r in range(len(ids))]
    edges = sorted({(max(dist[a, b], core[a], core[b]), *sorted((a, b))) for a in range(len(ids)) for b in near[a]}, key=lambda e: (e[0], ids[e[1]], ids[e[2]]))
    node, members, kids, lam = {i: i for i in range(len(ids))}, {i: [i] for i in range(len(ids))}, {}, {}
    roots = set(node)
    for w, a, b in edges:  # node[i]: the merge that i's part has come to
        x, y = node[a], node[b]
        if x != y:
            new = ("m", len(kids))
            kids[new], lam[new], members[new] = (x, y), int(SCALE // max(w, 1 / SCALE)), members[x] + members[y]
            roots = roots - {x, y} | {new}
            for i in members[new]:
                node[i] = new
    big = lambda x: len(members[x]) >= size

    def condensed(head, birth):
        """(stability, clusters below, rows) of the cluster that begins at a merge."""
        stability, x = 0, head
        while True:
            large = [c for c in kids[x] if big(c)]
            stability += sum(len(members[c]) for c in kids[x] if not big(c) or len(large) == 2) * (lam[x] - birth)
            if len(large) != 1:
                return {"head": head, "stability": stability, "below": [condensed(c, lam[x]) for c in large], "rows": members[head]}
            x = large[0]

    def best(c, able):
        below = [best(x, True) for x in c["below"]]
        total = sum(b[0] for b in below)
        if able and (not below or c["stability"] >= total):
            return c["stability"], [c["rows"]]
        return max(c["stability"], total) if below else c["stability"], [g for b in below for g in b[1]]

    heads = [r for r in roots if big(r)]
    groups = [g for r in heads for g in best(condensed(r, 0), single or len(heads) > 1)[1]]
    out = {i: -1 for i in ids}
    for n, group in enumerate(sorted(groups, key=lambda g: min(ids[i] for i in g))):
        out |= {ids[i]: n for i in group}
    return out


def planted(seed=1, groups=5, each=45, noise=75, dim=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    vecs = np.concatenate([*(c + rng.normal(size=(each, dim)) * s for c, s in zip(centres, np.linspace(0.1, 0.4, groups), strict=True)), rng.normal(size=(noise, dim))])
    vecs[3] = vecs[4] = vecs[5]
    return rng.permutation(len(vecs)).tolist(), vecs, np.repeat([*range(groups), -1], [each] * groups + [noise])


def clusters(spark, ids, vecs, parts=4, **how):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vecs, strict=True)], "vec_id long, e array<double>").repartition(parts)
    return dict(map(tuple, D.density_clusters(df, **how).collect()))


@pytest.mark.parametrize(("size", "samples", "k", "at_once", "parts"), [(5, 5, 299, 1 << 14, 64), (6, 3, 15, 64, 1)])
def test_equals_the_plain_hierarchy(spark, size, samples, k, at_once, parts):
    """The whole graph and a sparse one; merges in one block and by halving; all in one partition and in many."""
    ids, vecs, truth = planted() if k > 100 else planted(groups=3, each=30, noise=50)
    want = brute(ids, vecs, size, samples, k)
    assert clusters(spark, ids, vecs, parts, min_cluster_size=size, min_samples=samples, k=k, at_once=at_once) == want
    assert len(set(want.values())) > 3 and -1 in want.values()
    for g in set(truth) - {-1} if k > 100 else ():  # planted groups are found
        inside = [want[i] for i, t in zip(ids, truth, strict=True) if t == g]
        assert max(map(inside.count, set(inside) - {-1}), default=0) > 0.4 * len(inside)


def test_edges(spark):
    empty = spark.createDataFrame([], "vec_id long, e array<double>")
    assert D.density_clusters(empty).collect() == []
    same = spark.createDataFrame([*((i, [1.0, 2.0]) for i in range(12)), (20, None), (21, [-1.0, 0.5])], "vec_id long, e array<double>")
    assert set(dict(map(tuple, D.density_clusters(same).collect())).values()) == {-1}
    found = dict(map(tuple, D.density_clusters(same, single=True).collect()))
    assert found[20] == -1 and {found[i] for i in range(12)} == {0}
