"""The trie against one that is walked turn by turn."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from loomcast.llm import prefix_trie as T
from loomcast.llm.queries import rebuilt

KINDS = "conv_id long, turn long, role string, text string"


def sequences(rows):
    """Turns (role, text) of each conversation, in order."""
    out = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            out.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in out.items()}


def brute(seqs):
    members = {}
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    children, out = {}, []
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    def below(node):
        leaves, saved, todo = 0, 0, [node]
        while todo:
            x = todo.pop()
            saved += (len(members[x]) - 1) * (len(x[-1][1]) if x else 0)
            leaves += x not in children
            todo += children.get(x, [])
        return leaves, saved

    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(seqs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children.get(node, [])), *below(node), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def made(seed, convs=60, longest=37):
    rng, rows = random.Random(seed), []
    for c in range(convs):
        turns = rng.choice([1, 2, 3, 8, longest])
        chosen = rng.random() < 0.5
        for t in range(turns):
            text = f"t{t}" if chosen or rng.random() < 0.8 else rng.choice(["", None, "日本", "é x", "t1"])
            rows.append((c * 7 % 230, rng.choice([t, t, None]) if rng.random() < 0.1 else t, rng.choice(["user", "user", None]), text))
    return rows


def listed(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("parts", [1, 5])
def test_equals_a_walked_trie(spark, parts, monkeypatch):
    monkeypatch.setattr(T, "PIECE", 12)
    monkeypatch.setattr(T, "RUN", 5)
    rows = made(parts, longest=37 if parts == 1 else 70)
    df = spark.createDataFrame(random.Random(9).sample(rows, len(rows)), KINDS).repartition(parts)
    assert listed(T.conversation_trie(df)) == brute(sequences(rows))


def test_rebuilt_conversations(spark):
    import zlib

    rows = made(11)
    seqs = sequences(rows)
    want = {}
    for c, own in seqs.items():
        h = zlib.crc32(str(c).encode()) % 6
        want[c] = seqs.get(c - c % 100, [])[:h] + own[h:]
    numbered = T.numbered_turns(spark.createDataFrame(rows, KINDS), *(F.col(c) for c in ("conv_id", "turn", "role", "text")))
    assert listed(T.trie(*rebuilt(numbered))) == brute(want)


def test_edges(spark):
    made_of = lambda rows: listed(T.conversation_trie(spark.createDataFrame(rows, KINDS)))
    assert made_of([]) == []
    assert made_of([(None, 0, "user", "x")]) == []
    same = [(c, t, "user", "x" * t) for c in (3, 1, 2) for t in (5, 5, 9)] + [(4, None, None, None)]
    assert made_of(same) == brute(sequences(same))
    long = [(1, 0, "user", "y" * 300_000), (2, 0, "user", "y" * 300_000), (2, 1, "user", "z")]
    assert made_of(long) == brute(sequences(long))
    # Only turnless conversations: the root.
    alone = T.trie(spark.createDataFrame([], "conv_id long, pos long, key binary, chars long"), spark.createDataFrame([(7,), (3,), (3,)], "conv_id long"))
    assert listed(alone) == [(3, 0, None, 2, 0, 1, 0, hashlib.sha256(b"3,7").hexdigest())]


def test_clashing_columns_and_roles_that_run_into_texts(spark):
    rows = [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, "a:b", "c"), (3, 1, "a", ":bc")]
    df = spark.createDataFrame([(*r, 5) for r in rows], KINDS + ", pos int").withColumn("key", F.lit("k")).withColumn("at", F.lit(1)).withColumn("chars", F.lit(0))
    assert listed(T.conversation_trie(df)) == brute(sequences(rows))
