"""Classes just outside a component are held against it in tasks: no link is lost, and pairs are no rows."""

import random

import pytest

from loomcast.llm import near_dedup as N


@pytest.mark.parametrize("part", [1 << 19, 700])
def test_one_similar_member_of_each(spark, monkeypatch, part):
    monkeypatch.setattr(N, "SHINGLES_A_PART", part)
    rng = random.Random(part)
    base = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(120)]
    change = lambda s, k: [rng.randrange(-(1 << 63), 1 << 63) if i in at else x for at in [rng.sample(range(len(s)), k)] for i, x in enumerate(s)]
    sets = {i: change(base, rng.choice((0, 5, 11, 14))) for i in range(30)} | {100 + i: change(base, rng.choice((3, 8, 12, 20, 60))) for i in range(40)} | {200: base[:10]}
    rows = spark.createDataFrame([(c, s, len(s)) for c, s in sets.items()], "cls long, s array<long>, n int")
    members = spark.createDataFrame([(i, 7 if i < 20 else 8) for i in range(30)], "cls long, big long")
    asked = spark.createDataFrame([(q, big) for q in sets if q >= 100 for big in (7, 8)], "q long, big long")
    like = lambda a, b: len(set(sets[a]) & set(sets[b])) / len(set(sets[a]) | set(sets[b])) >= 0.8
    found = [(r.a, r.b) for r in N._one_of(asked, members, rows, 0.8).collect()]
    assert all(like(a, b) and a < 30 and b >= 100 for a, b in found)
    want = {(7 if m < 20 else 8, q) for m in range(30) for q in sets if q >= 100 and like(m, q)}
    assert {(7 if m < 20 else 8, q) for m, q in found} == want and 10 < len(want) < 82
    if part > 700:
        assert len(found) == len(want)  # one of each, not each pair


def test_large_component_is_not_paired(spark, monkeypatch):
    rng, base = random.Random(2), [f"w{i}" for i in range(200)]

    def copy(edits):
        at = rng.sample(range(200), edits)
        return " ".join(f"x{rng.randrange(10**6)}" if i in at else w for i, w in enumerate(base))

    # At 196 shingles two edits and two are similar, two and three are just not.
    docs = spark.createDataFrame([(i, copy(2 if i < 100 else 3)) for i in range(112)], "doc_id long, text string").cache()
    seen, inner = [], N._between

    def spy(*args):
        rest, links = inner(*args)
        seen.append(rest.count() + links.count())
        return rest, links

    monkeypatch.setattr(N, "_between", spy)
    got = {r.doc_id: r.component_id for r in N.near_duplicates(docs).collect()}
    from tests.llm.test_near_dedup import brute_groups

    assert got == brute_groups({r.doc_id: r.text for r in docs.collect()})
    assert len(seen) == 1 and seen[0] <= 12 * 11 / 2 + 112  # before: 12 times 100 more
