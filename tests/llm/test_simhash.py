import random

import numpy as np
import xxhash

from loomcast.llm import simhash as S


def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(items):
    """items: (id, fp); smallest id reachable over links of at most three bits."""
    root = {i: i for i, _ in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, f) in enumerate(items):
        for j, g in items[:n]:
            if (f ^ g).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i, _ in items}


def test_golay_decodes_every_error_of_three_bits():
    golay, rng = S.Golay(), random.Random(1)
    for _ in range(200):
        word = rng.getrandbits(23)
        code = (int(golay.decode(np.array([word]))[0]), word)
        nearest = word ^ int(golay.leaders[S._syndromes(np.array([word]))[0]])
        assert (nearest ^ word).bit_count() <= 3 and S._syndromes(np.array([nearest]))[0] == 0
        assert code[0] == nearest >> 11


def test_keys_miss_no_pair_within_three_bits():
    rng, golay = random.Random(7), S.Golay()
    for _ in range(1500):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(1, 3)):
            b ^= 1 << bit
        pair = np.array([a, b], dtype=np.uint64).view(np.int64)
        (pr, pk), (ir, ik) = S.fuzzy_keys(pair, golay, True), S.fuzzy_keys(pair, golay, False)
        assert set(pk[pr == 0]) & set(ik[ir == 1]) or set(pk[pr == 1]) & set(ik[ir == 0])


def test_matches_brute_force(spark):
    rng = random.Random(3)
    words = ["alpha", "Beta", "gamma", "délta", "EPS", "zeta", "eta", "ß", "iota"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(60)]
    texts += [t + " extra" for t in texts[:20]] + texts[:15] + [None, "", " \t\n", " ", "one", "One two", "x " * 40000]
    rows = [(i, t, "clash", 1.0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id double")
    got = {r.doc_id: r for r in S.near_duplicates(docs).collect()}
    prints = [(i, brute_fingerprint(t)) for i, t, *_ in rows]
    want = brute_components(prints)
    assert len(got) == len(rows)
    for i, fp in prints:
        assert got[i].fp % (1 << 64) == fp and got[i].component_id == want[i], i


def test_links_chains_of_planted_fingerprints(spark):
    rng = random.Random(11)
    fps = []
    for _ in range(40):
        f = rng.getrandbits(64)
        for _ in range(rng.randint(1, 6)):  # chains: ends may be far apart
            fps.append(f)
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                f ^= 1 << bit
    fps = sorted(set(fps))
    classes = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    got = {tuple(sorted((r.a % (1 << 64), r.b % (1 << 64)))) for r in S.links(classes).collect()}
    assert got == {(a, b) for n, b in enumerate(fps) for a in fps[:n] if (a ^ b).bit_count() <= 3}


def test_null_ids_repeats_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b c"), (4, "a b c"), (4, "a b c"), (9, "q r s t")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.component_id) for r in S.near_duplicates(docs).collect())
    assert got == [(-1, 4), (4, 4), (4, 4), (9, 9)]
    assert S.near_duplicates(docs.limit(0)).count() == 0
