import random
import re
import zlib

import numpy as np

from loomcast.llm import quality as Q


def slow_counts(text):
    """bucket_counts by the definition, gram by gram."""
    counts, m = np.zeros(Q.BUCKETS, int), (1 << 32) - 1
    space = " \t\n\x0b\x0c\r"

    def spread(h):
        h = ((h ^ (h >> 15)) * 0x2C1B3C6D) & m
        return (h ^ (h >> 13)) & (Q.BUCKETS - 1)

    for n in Q.GRAMS:
        for i in range(len(text) - n + 1):
            gram = text[i : i + n]
            if any(c in space for c in gram[1:-1]) or all(c in space for c in gram):
                continue
            h = 0x811C9DC5 + n
            for c in gram:
                h = ((h ^ ord(c)) * 0x01000193) & m
            counts[spread(h)] += 1
    words = []
    for w in re.findall(r"[^\x20\x09-\x0D]+", text):
        h = sum((ord(c) + 1) * pow(0x01000193, i % 1024 + 1, 1 << 32) for i, c in enumerate(w)) & m
        words.append(h ^ 0x9E3779B9)
        counts[spread(words[-1])] += 1
    counts[Q.SAME] += sum(a == b for a, b in zip(words, words[1:]))
    runs = list(zip(words, words[1:], words[2:]))
    counts[Q.AGAIN] += len(runs) - len(set(runs))
    return counts


def test_counts_match_the_definition(monkeypatch):
    for text in ("", " ", "a", "one two two two one two two", "ünï  cödé\n\tx 漢字🙂", "y" * 3000):
        assert (Q.bucket_counts(text) == slow_counts(text)).all(), text
    rng = random.Random(3)
    text = " ".join("".join(rng.choices("abcd", k=rng.randint(1, 9))) for _ in range(3000)) + " " + "z" * 5000 + " a b a b a b " * 300
    whole = Q.bucket_counts(text)
    for size in (7, 1000, 4999):
        monkeypatch.setattr(Q, "AT_ONCE", size)
        assert (Q.bucket_counts(text) == whole).all(), size


def corpus(n, seed):
    rng = random.Random(seed)
    good = ["river", "stone", "over", "under", "walks", "tall", "quiet", "green"]
    bad = ["BUY!!", "win$$$", "click###", "xx%%%", "tall", "green"]
    return [(i, " ".join(rng.choices(good if i % 4 else bad, k=rng.randint(6, 60))), int(bool(i % 4))) for i in range(n)]


def test_held_out_accuracy(spark):
    rows = corpus(400, 1)
    docs = spark.createDataFrame([(i, t, "en") for i, t, _ in rows] + [(None, None, None), (900, "", "x"), (901, "long " * 100000, "y")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(None, 1), (2, None), (3, 0)], "doc_id long, quality int")
    model = Q.fit(docs, labels.where(~Q.held_out()))
    got = Q.score(docs, model).withColumn("held", Q.held_out()).collect()
    assert len(got) == len(rows) + 3 and all(0 <= r.score <= 1 for r in got)
    held = {r.doc_id: r.score for r in got if r.held}
    truth = {i: q for i, _, q in rows}
    assert set(held) & set(truth) == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    right = [(held[i] >= 0.3) == truth[i] for i in held if i in truth]
    assert sum(right) / len(right) > 0.95
    again = Q.fit(docs.repartition(7), labels.where(~Q.held_out()).repartition(3))
    assert np.allclose(again.weights, model.weights) and again.bias == model.bias
    kept = Q.accepted(docs, model)
    assert kept.columns == docs.columns


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in Q.score(docs, Q.fit(docs, none)).collect()] == [0.5, 0.5]
    assert Q.score(docs.limit(0), Q.fit(docs.limit(0), none)).count() == 0
