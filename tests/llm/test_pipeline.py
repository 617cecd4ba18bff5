"""The pipeline against a plain Python version of its stages' decisions."""

import importlib.util
import re

import numpy as np
import pytest

from loomcast.llm import packing, pii, quality
from loomcast.llm.queries import quality_model
from tests.llm.test_packing import check_sequences, library_ids
from tests.llm.test_near_dedup import brute_groups

pytestmark = pytest.mark.skipif(importlib.util.find_spec("corpus_pipeline") is None, reason="no pipeline here")


def tables(spark, path):
    from tests.llm.test_quality import corpus

    rows = corpus(220, 5)
    rows += [(500 + i, rows[4 * i + 1][1] + (" " if i % 2 else "  "), 1) for i in range(20)]  # exact copies but for white space
    long = " ".join(f"w{i}" for i in range(900))
    rows += [(600 + i, long + f" end{i}", 1) for i in range(5)] + [(700, "mail a.b@example.com from 10.1.2.3 quiet river stone over", 1), (701, None, 1), (702, "", 1)]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t, _ in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, q, 0) for i, _, q in rows], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return {i: t or "" for i, t, _ in rows}


def test_stages_and_run(spark, tmp_path):
    import corpus_pipeline as C

    texts = tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = quality_model(spark, str(tmp_path), docs)
    kept = {i: t for i, t in texts.items() if model.score(quality.bucket_counts(t)) >= 0.3}
    assert 100 < len(kept) < len(texts)
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t) for i, t in kept.items()}
    kept = {i: t for i, t in kept.items() if i == min(j for j in norm if norm[j] == norm[i])}
    comp = brute_groups(kept)
    kept = {i: t for i, t in kept.items() if comp[i] == i}
    assert sum(i in kept for i in range(600, 605)) < 5
    make = pii.Pseudonyms(pii.session_key(spark))
    want = {i: pii.pseudonymise(t, make)[0] for i, t in kept.items()}
    assert "a.b@" not in want[700]
    for name, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    assert {r.doc_id: r.text or "" for r in docs.collect()} == want
    got = C.run(spark, str(tmp_path)).collect()
    lengths = {}
    for r in got:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert lengths == {i: len(library_ids(t)) + 1 for i, t in want.items()}
    bins = check_sequences(got, packing.CAPACITY)
    assert bins == packing.lower_bound(np.array([r.length for r in got]), packing.CAPACITY)


def test_stages_take_odd_rows(spark, tmp_path):
    import corpus_pipeline as C

    tables(spark, tmp_path)
    long = "river stone over under walks tall quiet green " * 40000
    rows = [(1, "river stone over", "en", None, 3), (1, "river stone over", "en", None, 3), (1, "quiet green river", None, "s", None), (None, "river  stone over", "fr", "s", 1), (None, None, None, None, None),
            (None, "", "", "", 0), (4, long, "en", "s", len(long)), (5, long + "mail x.y@example.com", "en", "s", 9), (6, "call 212-555-0199 quiet river stone", "en", "s", 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, cls string, found map<string,int>, part string, open string"
    docs = spark.createDataFrame([(*r, "s", "c", None, "p", "o") for r in rows], schema)
    left = docs
    for _, stage in C.STAGES[:-1]:
        left = stage(spark, left, str(tmp_path))
        assert left.columns == docs.columns
    got = sorted(((r.doc_id or 0, (r.text or "")[:12]) for r in left.collect()))
    assert got == [(0, ""), (1, "quiet green "), (1, "river stone "), (4, "river stone "), (6, got[-1][1])] and "212-555" not in str(got)
    last = C.STAGES[-1][1](spark, left, str(tmp_path)).collect()
    check_sequences(last, packing.CAPACITY)
    assert {r.doc_id for r in last} == {None, 1, 4, 6}
    empty = docs.limit(0)
    for _, stage in C.STAGES:
        empty = stage(spark, empty, str(tmp_path)) if "text" in empty.columns else empty
        assert empty.count() == 0
