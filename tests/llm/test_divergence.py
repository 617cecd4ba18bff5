"""Divergence audit against a dense table in plain Python."""

import random
import re
from collections import Counter

import pytest

from loomcast.llm import divergence as D

KINDS = "doc_id long, text string, lang string, source string"


def brute(rows, min_docs=10, top=10):
    """rows of (text, lang, source); every kept term in every group, as the contract puts it."""
    docs = [(l or "", s or "", [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", t or "")]) for t, l, s in rows]
    out = []
    for lang in {d[0] for d in docs}:
        df, whole = Counter(), Counter()
        groups = {s: Counter() for l, s, _ in docs if l == lang}
        for l, s, words in docs:
            if l == lang:
                df.update(set(words))
                whole.update(words)
                groups[s].update(words)
        kept = [t for t, n in df.items() if n >= min_docs]

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        f, q = lambda a, b: (a - b) ** 2 // (a + b), shares(whole)
        p = {s: shares(c) for s, c in groups.items()}
        for s in groups:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in groups if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found)]
    return sorted(out)


def made(seed, n=200):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "GAMMA", "délta", "Éta", "été", "zeta-one", "o'clock", "日本 語", "k9x", "_under_", "ß", "ẞ"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = []
    for _ in range(n):
        source = rng.choice(["a", "b", "c", None, "hot", "hot", "hot", "é", "z"])
        text = " ".join(rng.choices(words, [1 / (i + 1 + 7 * (source == "b")) for i in range(len(words))], k=rng.choice([0, 3, 8, 30])))
        rows.append((rng.choice([text, text, text, None, ""]), rng.choice(["en", "en", "de", None]), source))
    return rows


@pytest.mark.parametrize("parts", [1, 7])
def test_equals_a_dense_table(spark, parts, monkeypatch):
    monkeypatch.setattr(D, "HELD", 50)
    rows = made(parts)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], KINDS).repartition(parts)
    assert sorted(map(tuple, D.audit(df).collect())) == brute(rows)
    assert sorted(map(tuple, D.audit(df, min_docs=40, top_terms=2).collect())) == brute(rows, 40, 2)


def test_edges(spark):
    audit = lambda rows: sorted(map(tuple, D.audit(spark.createDataFrame(rows, KINDS)).collect()))
    assert audit([]) == []
    assert audit([(1, "only one", "en", "a")]) == []
    # No kept term: pairs of 0; a group without terms is still there.
    assert audit([(1, "x", "en", "a"), (2, None, "en", None)]) == [("en", "", "pair", "a", 0, 1), ("en", "a", "pair", "", 0, 1)]
    # Repeated rows, null ids and a very long text count.
    rows = [("same Words", "en", "a")] * 12 + [("long " * 300_000 + "words", "en", "b")] * 10 + [("", "en", "c")]
    assert audit([(None, *r) for r in rows]) == brute(rows)


def test_clashing_columns(spark):
    rows = made(5, 80)
    df = spark.createDataFrame([(i, *r, "x") for i, r in enumerate(rows)], KINDS + ", x string")
    want = brute(rows)
    for name in ("term", "n", "docs", "p", "q", "v", "salt", "value", "rank"):
        assert sorted(map(tuple, D.audit(df.withColumnRenamed("x", name)).collect())) == want


def test_large_counts_stay_exact(spark):
    """Shares of groups whose counts don't fit in 64 bits once scaled."""
    n, total, v = 3 * 10**12, 9 * 10**13, 10**6
    row = spark.range(1).select(*[D.F.lit(x).cast("long").alias(a) for a, x in (("n", n), ("t", total), ("v", v))]).select(D.share(D.F.col("n"), D.F.col("t"), D.F.col("v"))).first()
    assert row[0] == 1 + 1_000_000_000 * (n + 2) // (total + 2 * v)
