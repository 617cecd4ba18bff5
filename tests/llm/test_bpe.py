import random
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from loomcast.llm import bpe as B

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@cache
def lib():
    return B.encoding(PATH, PATTERN)


TEXTS = ["Hello  world\n\n it's 's\t\ttab \n", None, "", "   ", "\n", "a\x1cb \x1d c\x85d\xa0e f　 g​", "12 345,é 漢字🙂<|endoftext|>", "x" * 3000, "w " * 40000, "don't I'LL  we've", " lead", "é ́a"]


def random_texts(n):
    rng = random.Random(9)
    chars = "ab é'st1 2\n\t  .,!漢🙂  \x1c\x0b"
    return ["".join(rng.choices(chars, k=rng.randint(1, 50))) for _ in range(n)]


def test_words_are_encoded_alone():
    for text in [t for t in TEXTS if t] + random_texts(3000):
        assert "".join(B.words_of(text)) == text
        assert [i for w in B.words_of(text) for i in lib().encode_ordinary(w)] == lib().encode_ordinary(text), ascii(text)


def test_matches_the_library_and_decodes(spark, tmp_path):
    texts = TEXTS + random_texts(150)
    rows = [(i, t, "n", 1) for i, t in enumerate(texts)] + [(None, "null id", "n", 1), (3, TEXTS[3], "n", 1)]
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, "doc_id long, text string, ids string, block int").repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    got = B.decode(B.encode(docs, PATH, PATTERN, block_chars=500), PATH).collect()
    assert len(got) == len(rows)
    want = {i: (t or "") for i, t, *_ in rows}
    for r in got:
        assert np.frombuffer(r.ids, "<u4").tolist() == lib().encode_ordinary(want[r.doc_id])
        assert bytes(r.decoded) == want[r.doc_id].encode()
    assert B.encode(docs.limit(0), PATH, PATTERN).count() == 0
    shuffled = B.encode(docs.repartition(5, "doc_id").orderBy(F.rand()).repartition(4, "doc_id"), PATH, PATTERN, block_chars=300)
    for r in B.decode(shuffled.withColumn("decoded", F.lit("old")), PATH).select("doc_id", "decoded").collect():
        assert bytes(r.decoded) == want[r.doc_id].encode()


def test_differing_readings_are_an_error(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    other = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    whole = B.word_positions
    monkeypatch.setattr(B, "word_positions", lambda d, i, t, n: whole(other.toDF("id", "text"), i, t, n))
    with pytest.raises(Exception, match="two readings differ"):
        B.encode(docs, PATH, PATTERN).collect()
