import hashlib
import re

from loomcast.llm import exact_dedup as X


def test_matches_brute_force(spark):
    texts = ["a  b", "a b", "a\tb", "A b", None, "", " ", "\n\n", "long " * 50000, "long " * 50000, " ", "x"]
    rows = [(i, t, "n", 0) for i, t in enumerate(texts)] * 1 + [(3, "A b", "n", 0), (None, "x", "n", 0), (None, "lone", "n", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string, keep_id int").repartition(5)
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t, *_ in rows]
    want = []
    for i, t in norm:
        ids = [j for j, u in norm if u == t]
        least = min((j for j in ids if j is not None), default=None)
        want.append((i, least, len(ids), i is not None and i == least, hashlib.sha256(t.encode()).hexdigest()))
    got = [tuple(r) for r in X.exact_dedup(docs, salts=2).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert X.exact_dedup(docs.limit(0)).count() == 0


def test_kept_rows_keep_their_columns(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, "b", None)], "doc_id long, text string, lang string")
    got = X.deduplicated(docs)
    assert got.columns == docs.columns and {r.doc_id for r in got.collect()} == {1, 3}


def test_repeated_and_null_ids_leave_one_row_a_text(spark):
    rows = [(3, "y"), (5, "x"), (5, "y"), (5, "x"), (None, "y"), (None, "z"), (None, "z "), (None, None), (7, "w"), (7, "v")]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, cls int")
    got = X.deduplicated(docs).collect()
    assert sorted((r.doc_id or 0, (r.text or "").strip()) for r in got) == [(0, ""), (0, "z"), (0, "z"), (3, "y"), (5, "x"), (7, "v"), (7, "w")]
    assert X.deduplicated(docs.limit(0)).count() == 0


def test_digest_clash_is_settled_by_content(spark, monkeypatch):
    """A digest of one value for all texts: content alone must tell them apart."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(X, "_rows", lambda docs, i, t: docs.select(F.col(i).alias("id"), X.normalised(t).alias("text"), F.unhex(F.lit("00")).alias("digest")))
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size) for r in X.exact_dedup(docs).collect()}
    assert got == {1: (1, 2), 2: (1, 2), 3: (3, 1)}
