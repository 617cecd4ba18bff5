import numpy as np

from loomcast.llm import lattice as L


def brute(rows, t=0.98):
    def unit(v):
        if v is None or any(x is None for x in v):
            return None
        v = np.array(v, np.float32).astype(float)
        return v / np.linalg.norm(v) if len(v) and np.isfinite(v).all() and v.any() else None

    us = [unit(v) if lab is not None else None for _, v, lab in rows]
    near = [[j for j in range(len(rows)) if j != i and us[i] is not None and us[j] is not None and len(us[i]) == len(us[j]) and rows[i][2] == rows[j][2] and us[i] @ us[j] >= t] for i in range(len(rows))]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        c = min(rows[j][0] for j in seen)
        out.append((rows[i][0], len(near[i]), c, rows[i][0] == c))
    return sorted(out)


def test_decode_finds_the_nearest_point():
    rng, near = np.random.default_rng(1), L.neighbours()
    assert near.shape == (240, 8) and np.allclose((near**2).sum(1), 2)
    x = rng.normal(size=(500, 8)) * 3
    at = L.decode_e8(x)
    d = ((x - at) ** 2).sum(1)
    others = ((x[:, None, :] - at[:, None, :] - near[None]) ** 2).sum(2)
    assert (d <= 1 + 1e-9).all() and (d[:, None] <= others + 1e-9).all()


def test_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = []
    for g in range(60):
        base = rng.normal(size=64)
        base /= np.linalg.norm(base)
        for _ in range(rng.integers(1, 7)):
            eps = rng.choice([0.0, 0.05, 0.12, 0.17, 0.2, 0.22])
            noise = rng.normal(size=64)
            v = base + eps * noise / np.linalg.norm(noise)
            rows.append((len(rows), [float(x) for x in v.astype(np.float32)], int(g % 3)))
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [0.0] * 64, 1), (n + 2, [float("nan")] * 64, 1), (n + 3, rows[0][1], None), (n + 4, [None] * 64, 1), (n + 5, [], 1), (n + 6, rows[3][1], rows[3][2]), (n + 7, [1.0, 0.0], 1), (n + 8, [1.0, 0.01], 1), (n + 9, [-0.0] * 64, 1)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("vec", __import__("pyspark").sql.functions.lit(1))
    got = sorted(tuple(r) for r in L.near_duplicates(docs).collect())
    assert got == brute(rows)
    assert L.near_duplicates(docs.limit(0)).count() == 0


def test_recall_at_the_threshold():
    """Pairs exactly at the cosine share a cell in some table."""
    rng, lat, missed = np.random.default_rng(2), L.Lattice(64, 0.98), 0
    for _ in range(400):
        a = rng.normal(size=64)
        a /= np.linalg.norm(a)
        b = rng.normal(size=64)
        b -= a * (a @ b)
        b = 0.98 * a + np.sqrt(1 - 0.98**2) * b / np.linalg.norm(b)
        found = [set(zip(*lat.keys(v[None], probing)[1:], strict=True)) for v in (a, b) for probing in (True, False)]
        x, y = (lat.signs(v[None])[0] for v in (a, b))
        assert sum(((int(p) ^ int(q)) & (2**64 - 1)).bit_count() for p, q in zip(x, y, strict=True)) <= L.most_signs(0.98)
        missed += not found[0] & found[3] and not found[2] & found[1]
    assert missed == 0


def test_candidates_grow_with_the_rows():
    """Unrelated vectors of one label: pairs that share a key, and pass the signs, stay far below one a vector."""
    rng = np.random.default_rng(8)
    for n in (2000, 4000):
        unit = rng.normal(size=(n, 64))
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        lat = L.Lattice(64, 0.98)
        held = {}
        for row, table, key in zip(*lat.keys(unit, False), strict=True):
            held.setdefault((table, key), []).append(row)
        pairs = {(min(row, x), max(row, x)) for row, table, key in zip(*lat.keys(unit, True), strict=True) for x in held.get((table, key), []) if x != row}
        assert len(pairs) <= n // 100
