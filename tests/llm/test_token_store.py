"""Wavelet matrices against plain arrays, and the written shards against the tokeniser's library."""

import glob
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loomcast.llm import token_store as S
from loomcast.llm.common import tokenizer_file

PATH = tokenizer_file("byte_bpe_50k.json")
KINDS = "doc_id long, text string"
TEXTS = [
    "Hello  world's it'll", "", " \n\t ", None, "É日本 語 x\x85y\x1cz   q", "a" * 3000, "<|endoftext|> stays text", "tabs\t\tand  spaces   ",
    "x\r\n\r\n y", "1234 56,7!?", "᠎​﻿ w", "Hello  world's it'll",
]


def library():
    lib = Tokenizer.from_file(PATH)
    lib.encode_special_tokens = True
    return lib


def expected(rows):
    """(doc_id, start, n_tokens, crc) in the order of the files."""
    lib, out, start = library(), [], 0
    for i, text in rows:
        ids = np.array([*lib.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("n", [0, 1, 5, S.CHUNK - 1, S.CHUNK, S.CHUNK + 1, 100_003])
def test_wavelet(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.2, n), 50_256).astype(np.uint32)
    w = S.Wavelet(S.packed(ids, 16))
    assert np.array_equal(w.ids(), ids)
    some = rng.integers(0, n, 50) if n else np.zeros(0, int)
    assert np.array_equal(w.at(some), ids[some])
    for token in {1, 2, 3, 50_256, 65_535, 70_000, *ids[:3].tolist()}:
        a, b = sorted(rng.integers(0, n + 1, 2).tolist())
        assert w.count(token) == (ids == token).sum() and w.count(token, a, b) == (ids[a:b] == token).sum()
        assert np.array_equal(w.places(token), np.flatnonzero(ids == token))


def test_planes_compress():
    ids = np.sort(np.random.default_rng(1).integers(0, 50_257, 200_000))
    assert len(S.packed(ids, 16)) < 0.6 * 2 * len(ids)


def test_words_give_the_librarys_ids():
    rng, lib, own = random.Random(3), library(), S.WordIds(PATH)
    pool = "aA9 .,'\n\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0      　᠎​﻿é日١²\U0001f600<|>_"
    words = ["it's", " don't 've x's", "naïve*** cœur, ﬁx ʼn 'tis ªb ×x a×b Ÿ.z _a a_ a- -a ²a a²", "Ǆ ȸ ɐb é̀a"]
    for text in words + [t or "" for t in TEXTS] + ["".join(rng.choices(pool, k=rng.randrange(1, 30))) for _ in range(3000)]:
        assert np.frombuffer(own.ids(text), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize(("parts", "shard"), [(1, 10**6), (5, 40)])
def test_written_and_read(spark, tmp_path, parts, shard):
    rows = list(enumerate(TEXTS * 4))
    df = spark.createDataFrame(random.Random(parts).sample(rows, len(rows)), KINDS).repartition(parts)
    S.write(df, f"{tmp_path}/t", PATH, shard_tokens=shard)
    got = S.read(spark, f"{tmp_path}/t").withColumn("crc", F.crc32("ids"))
    want = expected(rows)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.crc) for r in got.collect()) == want
    shards = S.shards(spark, f"{tmp_path}/t").select("n_tokens").collect()
    assert len(glob.glob(f"{tmp_path}/t/part-*")) == len(shards) and (shard > 40 or len(shards) > 10)
    flat = [x for _, t in rows for x in [*library().encode(t or "", add_special_tokens=False).ids, 0]]
    tokens = [0, flat[0], 65_000]
    assert {r.token: r.n for r in S.count_tokens(spark, f"{tmp_path}/t", tokens).collect()} == {t: flat.count(t) for t in tokens}
    found = S.occurrences(spark, f"{tmp_path}/t", tokens).collect()
    assert sorted((r.token, r.place) for r in found) == sorted((t, p) for p, t in enumerate(flat) if t in tokens)
    starts = {i: s for i, s, *_ in want}
    assert all(starts[r.doc_id] + r.at == r.place for r in found)
    places = spark.createDataFrame([(p,) for p in [0, 5, 5, len(flat) - 1, len(flat), -1, None, *range(10, 60)]], "place long")
    asked = {0, 5, len(flat) - 1, *range(10, 60)}
    assert sorted(map(tuple, S.tokens_at(places, f"{tmp_path}/t", cell=17).collect())) == [(p, flat[p]) for p in sorted(asked)]


def test_edges(spark, tmp_path):
    S.write(spark.createDataFrame([], KINDS), f"{tmp_path}/empty", PATH)
    assert S.read(spark, f"{tmp_path}/empty").collect() == [] and S.count_tokens(spark, f"{tmp_path}/empty", [3]).collect() == [(3, 0)]
    # Null and repeated ids, string ids, columns of the file's own names.
    rows = [(None, "b"), ("x", "a"), ("x", "a"), (None, None), ("w", "c" * 200_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "h string, payload string, start int")
    S.write(df, f"{tmp_path}/odd", PATH, id_col="h", text_col="payload", shard_tokens=2)
    got = S.read(spark, f"{tmp_path}/odd", id_col="start_id").orderBy("start").collect()
    assert [r.start_id for r in got] == [None, None, "w", "x", "x"]
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    lib = library()
    assert sorted(bytes(r.ids) for r in got) == sorted(np.array([*lib.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes() for _, t in rows)
