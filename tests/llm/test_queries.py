"""The registered queries as they stand, over the smallest tables: against SQL, or by what must hold of their results."""

import hashlib
import os
import zlib

import numpy as np
import pytest

from loomcast.llm import queries as L
from tests.llm.test_html_text import brute_extract
from tests.llm.test_packing import check_sequences, library_ids
from tests.llm.test_simhash import brute_components, brute_fingerprint
from tests.test_oracles import DATA, cell

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{DATA}/{name}')")
    return con


@pytest.mark.parametrize("name", sorted(L.oracle_sql()))
def test_matches_sql(spark, duck, name):
    df = L.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    rel = duck.execute(L.oracle_sql()[name])
    names = [c[0] for c in rel.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = sorted([cell(row[i]) for i in at] for row in rel.fetchall())
    assert sorted([cell(x) for x in r] for r in df.select(columns).collect()) == want


@pytest.fixture(scope="module")
def texts(duck):
    return {i: t or "" for i, t in duck.execute("SELECT doc_id, text FROM documents").fetchall()}


def test_op1(spark, texts):
    prints = [(i, brute_fingerprint(t)) for i, t in texts.items()]
    want = brute_components(prints)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in L.op1_simhash(spark, DATA).collect()} == {(i, f"{f:016x}", want[i]) for i, f in prints}


def test_op2(spark, texts):
    got = {}
    rows = L.op2_packing(spark, DATA).collect()
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    for i, t in texts.items():
        ids = np.array([*library_ids(t), 0], "<u4")
        assert sorted(got[i]) == [(p, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())) for p, a in enumerate(range(0, len(ids), 2048))]
    from loomcast.llm.packing import lower_bound

    bound = lower_bound(np.array([r.length for r in rows]), 2048)
    assert bound <= check_sequences(rows, 2048) <= bound + 1


def test_op3(spark, texts):
    from loomcast.llm import pii

    make = pii.Pseudonyms(pii.session_key(spark))
    want = {i: pii.pseudonymise(t, make) for i, t in texts.items()}
    got = {r.doc_id: r for r in L.op3_pii(spark, DATA).collect()}
    assert {i: (r.text or "", r.n_replaced) for i, r in got.items()} == {i: (t, sum(c.values())) for i, (t, c) in want.items()}
    undo = pii.Pseudonyms(pii.session_key(spark), True)
    assert all(pii.pseudonymise(r.text or "", undo)[0] == texts[i] for i, r in got.items())


def test_op5(spark, duck):
    rows = duck.execute("SELECT page_id, url, html FROM pages").fetchall()
    got = sorted(((r.page_id, r.url, r.text) for r in L.op5_html_text(spark, DATA).collect()), key=str)
    assert got == brute_extract(rows)


def test_op8(spark, texts):
    from tests.llm.test_bpe import lib

    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in L.op8_byte_bpe(spark, DATA).collect()}
    for i, t in texts.items():
        ids = lib().encode_ordinary(t)
        assert got[i] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())


def test_op12(spark, texts):
    from tests.llm.test_token_store import expected

    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in L.op12_wavelet(spark, DATA).collect())
    assert got == expected(sorted(texts.items()))


def test_op10(spark, texts, duck):
    got = {r.doc_id: r for r in L.op10_quality(spark, DATA).collect()}
    assert set(got) == set(texts)
    labels = {i: q for i, q in duck.execute("SELECT doc_id, quality FROM labels").fetchall() if q is not None}
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(got[i].score, q) for i, q in labels.items() if got[i].held_out]
    pairs = [(a > b) + (a == b) / 2 for a, p in held for b, q in held if p == 1 and q == 0]
    assert len(held) > 5 and (not pairs or np.mean(pairs) > 0.9)
