import random

from loomcast.llm import near_dedup as N
from loomcast.llm.simhash import simhash


def brute_shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_groups(texts):
    sets, root = {i: brute_shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and (a == b or len(a & b) / len(a | b) >= 0.8):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in texts}


def test_groups_match_true_similarity(spark):
    rng, texts = random.Random(5), {}
    vocabulary = [f"w{i}" for i in range(3000)]
    for k in range(60):
        words = rng.choices(vocabulary, k=rng.randint(60, 200))
        for edits in range(rng.randint(1, 5)):  # each copy has one word changed for every 50 words, and more
            copy = list(words)
            for at in rng.sample(range(len(words)), edits * len(words) // 100 + (edits > 0)):
                copy[at] = rng.choice(vocabulary)
            texts[len(texts)] = " ".join(copy)
    base = rng.choices(vocabulary, k=60)
    for edits in range(80):  # one base: some pairs are similar, others just not
        at = rng.sample(range(60), edits % 4)
        texts[len(texts)] = " ".join(rng.choice(vocabulary) if i in at else w for i, w in enumerate(base))
    texts |= {900 + i: t for i, t in enumerate(["", None, " \n", "one two", "One  two", "one two three"])}
    want = brute_groups(texts)
    far = [(i, j) for i, j in want.items() if i != j and (simhash((texts[i] or "").encode()) ^ simhash((texts[j] or "").encode())).bit_count() > 3]
    assert len(far) > 10  # near copies that three bits of SimHash don't link
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in N.near_duplicates(docs).collect()} == want
    import corpus_pipeline

    kept = corpus_pipeline.without_near_copies(spark, docs, "").collect()
    assert {r.doc_id for r in kept} == {i for i, j in want.items() if i == j}


def test_rows_without_id_or_similarity_stay(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (3, "f e d c b a"), (3, "x")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.text) for r in N.one_of_each(docs).collect()) == [(1, "a b c d e f"), (3, "f e d c b a"), (3, "x")]
    assert N.one_of_each(docs.limit(0)).count() == 0
    rows = [(3, "y y"), (5, "x x"), (5, "Y  y"), (5, "x x"), (None, "z z"), (None, "Z z"), (None, None), (8, ""), (8, " ")]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, cls int")
    got = N.one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, (r.text or "").strip().lower()) for r in got.collect()) == [(0, "z z"), (3, "y y"), (5, "x x"), (8, "")]
    long = " ".join(f"w{i}" for i in range(200000))
    docs = spark.createDataFrame([(1, long), (2, long + " more"), (3, "w1 " + long)], "doc_id long, text string")
    assert [r.doc_id for r in N.one_of_each(docs).collect()] == [1]


def test_prefix_keys_miss_no_similar_pair(spark):
    rng, sets = random.Random(9), {}
    for i in range(150):
        common = set(rng.sample(range(25), rng.randint(1, 25)))
        sets[i] = sorted(common | {1000 + rng.randrange(300) for _ in range(rng.randint(0, 3))})
    index, probe = ([(r.key, r.n, r.cls) for r in x.collect()] for x in N._prefixes(spark.createDataFrame(list(sets.items()), "cls long, s array<long>"), 0.8))
    met = {(a, b) for k, m, a in index for q, n, b in probe if k == q and (m, a) < (n, b)}
    for a, x in sets.items():
        for b, y in sets.items():
            if (len(x), a) < (len(y), b) and len(set(x) & set(y)) / len(set(x) | set(y)) >= 0.8:
                assert (a, b) in met
