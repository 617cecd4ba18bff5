"""Tiles in numpy: quick similarities decide nothing, and what a tile yields doesn't grow with its steps."""

import numpy as np
import pyarrow as pa
import pytest

from loomcast.operators import search as Q


def tile(x, y, **columns):
    unit = [v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300) for v in (x, y)]
    rows = {"r": range(len(y)), "label": [i % 3 for i in range(len(y))]}
    return Q.Tile(pa.table({"q": range(len(x)), "sub": [i % 2 for i in range(len(x))]}), pa.table(rows), *unit, 6), np.round(unit[0] @ unit[1].T, 6) + 0.0


@pytest.fixture(params=["plain", "equal", "close"])
def case(request, monkeypatch):
    monkeypatch.setattr(Q, "TILE_STEP", 20_000)
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(150, 16)), rng.normal(size=(3000, 16))
    if request.param == "equal":
        y[500:2500] = y[3]
        x[20:120] = y[3]
    if request.param == "close":  # apart by less than single precision tells
        y[500:600] = y[3] * (1 + 1e-3) + rng.normal(size=(100, 16)) * 1e-4
        x[20:40] = y[3]
    return tile(x, y)


def test_best_rows(case):
    t, sims = case
    least = np.where(np.arange(3000) % 4 == 0, 0.4, 0.8)
    for keys, low, apart in (((), None, None), ((), lambda rows: least, ("q", "r")), (("label",), 0.5, None)):
        want = set()
        for q in range(150):
            for g in range(3 if keys else 1):
                fits = [r for r in range(3000) if (not keys or r % 3 == g) and (low is None or sims[q, r] >= (least[r] if callable(low) else low)) and not (apart and q == r)]
                want |= {(q, r, sims[q, r]) for r in sorted(fits, key=lambda r: (-sims[q, r], r))[:5]}
        assert set(zip(*(x.tolist() for x in Q.best_rows(5, keys, low, apart)(t)), strict=True)) == want


def test_best_queries_are_one_a_row_and_key(case):
    t, sims = case
    i, j, v = Q.best_queries(0.3, "sub")(t)
    want = {(s, r): sims[s::2, r].max() for s in (0, 1) for r in range(3000) if sims[s::2, r].max() >= 0.3}
    assert len(j) == len(want)  # before: a row for each step of queries
    assert {(a % 2, b): c for a, b, c in zip(i.tolist(), j.tolist(), v.tolist(), strict=True)} == want
    assert (sims[i, j] == v).all()


def test_counts_and_pairs(case):
    t, sims = case
    least = float(sims[7, 11])  # a row lies just there
    i, _, n = Q.count_rows(least)(t)
    assert dict(zip(i.tolist(), n.tolist(), strict=True)) == {q: int((sims[q] >= least).sum()) for q in range(150) if (sims[q] >= least).any()}
    i, j, v = Q.some_pair(least, "sub", "label")(t)
    assert len(i) == len({(a % 2, b % 3) for a, b in zip(i, j, strict=True)})
    assert {(a % 2, b % 3) for a, b in zip(i, j, strict=True)} == {(q % 2, r % 3) for q, r in np.argwhere(sims > least)}
