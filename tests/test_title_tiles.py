"""Titles in tiles: bounds that miss no match and leave few pairs, and the best match without all copies meeting each other."""

import difflib
import random

import pytest

from loomcast.operators import fuzzy as Z


def ratio(a, b):
    return difflib.SequenceMatcher(None, a.lower(), b.lower()).ratio()


def made_up(rng, count, long):
    out = []
    for _ in range(count):
        base = "".join(rng.choices("etaonrishdé İß漢 ", k=rng.randrange(1, long))) or "x"
        out += [base, "".join(c for c in base if rng.random() > 0.1) or "y", base[len(base) // 3 :] + base[: len(base) // 3]]
    return sorted(set(out))


@pytest.mark.parametrize("long,limit", [(40, 0.75), (40, 0.5), (150, 0.8), (400, 0.75)])
def test_bounds_miss_none(long, limit):
    rng = random.Random(long)
    a, b = made_up(rng, 25, long), made_up(rng, 20, long)
    b = sorted(set(b + a[::3]))
    pairs = [(i, j) for x in Z.possible_pairs(a, b, limit) for i, j in zip(*x, strict=True)]
    assert len(pairs) == len(set(pairs)) and {(i, j) for i in range(len(a)) for j in range(len(b)) if ratio(a[i], b[j]) >= limit} <= set(pairs)
    own = [tuple(sorted(p)) for x in Z.possible_pairs(a, None, limit) for p in zip(*x, strict=True)]
    assert len(own) == len(set(own)) and all(i < j for i, j in own)
    assert {tuple(sorted((i, j))) for i in range(len(a)) for j in range(len(a)) if i != j and ratio(a[i], a[j]) >= limit} <= set(own)


def test_bounds_leave_few():
    rng = random.Random(1)
    words = ["".join(rng.choices("etaonrishdlu", k=rng.randrange(2, 8))) for _ in range(300)]
    titles = sorted({" ".join(rng.choices(words, k=9))[:60] for _ in range(1500)})
    assert sum(len(i) for i, _ in Z.possible_pairs(titles, None, 0.75)) <= 0.001 * len(titles) ** 2 / 2


def test_parts_meet_whole(spark, monkeypatch):
    monkeypatch.setattr(Z, "TILE_TITLES", 16)
    rng = random.Random(3)
    titles = made_up(rng, 30, 30)
    rows = [(k, t) for n, t in enumerate(titles) for k in ((1, 2) if n % 7 else (1, 3 + n))] + [(None, "x"), (1, None), (1, "")]
    df = spark.createDataFrame(rows, "key int, title string")
    whole = [(k, t) for k, t in rows if k is not None and t]
    want = sorted((k, a, b, ratio(a, b)) for k, a in whole for q, b in whole if k == q and ratio(a, b) >= 0.75)
    assert sorted(map(tuple, Z.title_pairs(df).collect())) == want
    assert sorted(map(tuple, Z.title_pairs(df, df).collect())) == want


@pytest.mark.parametrize("many", [1, 32])
def test_best_matches(spark, monkeypatch, many):
    monkeypatch.setattr(Z, "MANY", many)
    rng = random.Random(4)
    bases = ["a day at the races", "a day at the race", "nights at the opera", "night at the opera", "alone"]
    rows = [(rng.randrange(2), rng.choice(bases), i * rng.choice((1, 3)), rng.choice((100, 105, 109, 111, 150, 0))) for i in range(150)]
    rows += [(0, "once", 5, 7), (0, None, 6, 7), (None, "once", 8, 7)]
    best = {}
    for k, t, i, n in rows:
        for q, u, j, m in rows:
            if i != j and k is not None and k == q and t and u and (x := ratio(t, u)) >= 0.75:
                apart = abs(i - j)
                bonus = (0.15 if apart <= 7 else 0.1 if apart <= 14 else 0.05 if apart <= 30 else 0) + 0.1 * (abs(n - m) <= 0.1 * n)
                best[i] = max(best.get(i, (0, 0)), (round(x + bonus, 6), -j))
    got = Z.best_matches(spark.createDataFrame(rows, "key int, title string, i int, n int"), "i", "n").collect()
    assert {r.i: (r.score, -r.other_id) for r in got} == best and len(got) == len(best)


def test_copies_dont_meet_one_by_one(spark):
    rows = spark.range(4000).selectExpr("0 key", "'the same title' title", "id * 40 i", "100 n")
    before = spark.sparkContext._jsc.sc().listenerBus()
    got = {r.i: (r.other_id, r.score) for r in Z.best_matches(rows, "i", "n").collect()}
    before.waitUntilEmpty()
    assert got == {40 * i: (0 if i else 40, 1.1) for i in range(4000)}
    largest = 0
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
    for k in range(min(40, stages.size())):
        largest = max(largest, stages.apply(k).shuffleReadRecords())
    assert largest < 50_000


def test_copies_of_many_sizes_dont_meet_one_by_one(spark):
    rows = spark.range(3000).selectExpr("0 key", "'the same title' title", "id * 40 i", "id + 1 n")
    got = {r.i: (r.other_id, r.score) for r in Z.best_matches(rows, "i", "n").collect()}
    for k in (0, 1, 15, 800, 2999):
        other = min(j for j in range(3000) if j != k and (abs(j - k) <= 0.1 * (k + 1) or k < 10))
        assert got[40 * k] == (40 * other, 1.1 if abs(other - k) <= 0.1 * (k + 1) else 1.0)
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
    assert max(stages.apply(k).shuffleReadRecords() for k in range(min(40, stages.size()))) < 300_000  # of 9 million
