import functools
import random
import zlib

import numpy as np
import public_tokenizers

from loomcast.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "Hello  World's it'll don't", "", " \n\t ", "ÉCOLE école ́x ſ İ ΣΑΣ ς ß", "a" * 5000, "123 45,6 %%% ***", "tab\there\x0bvt\x0cff\x1cfs\x1eok x\x85y z w　v",
    "<|endoftext|> <|startoftext|>x", "中文 字符 🙂🙂 a🙂b", "x" + "̀" * 40, "l'été's 'S 'Re 'LL we'RE", "word " * 9000, " a b​c", None,
]


@functools.cache
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def library_ids(text):
    return library().encode(text, add_special_tokens=False).ids


def test_ids_equal_the_library():
    tok, rng = P.ChunkTokenizer(PATH), random.Random(4)
    alphabet = "aBcé's'T 'll\n\t.,!1́İΣςßÅÅ \u0085ẞﬁ漢🙂‍"
    for text in [t for t in TEXTS if t is not None] + ["".join(rng.choices(alphabet, k=rng.randint(1, 60))) for _ in range(400)]:
        assert np.frombuffer(tok.ids(text), "<u4").tolist() == library_ids(text), ascii(text)


def test_bound_never_exceeds_an_optimum():
    rng = random.Random(8)
    for _ in range(300):
        cap, bins, lengths = rng.choice([10, 24, 100]), rng.randint(1, 8), []
        for _ in range(bins):  # cut full bins: the optimum is at most `bins`
            left = cap
            while left:
                x = rng.randint(1, left)
                lengths.append(x)
                left -= x
        assert P.lower_bound(np.array(lengths), cap) <= bins
        assert P.lower_bound(np.array(lengths), cap) >= -(-sum(lengths) // cap)
    assert P.lower_bound(np.array([60] * 5), 100) == 5 and P.lower_bound(np.array([34] * 9), 100) == 5


def test_pieces_and_packing(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string")
    parts = P.pieces(docs, PATH, with_ids=True)
    by_doc = {}
    for r in parts.collect():
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by_doc.setdefault(r.doc_id, {})[r.piece] = r
    for i, t in enumerate(TEXTS):
        ids = [*library_ids(t or ""), 0]
        got = [by_doc[i][p] for p in range(len(by_doc[i]))]
        assert [x for r in got for x in np.frombuffer(r.ids, "<u4")] == ids
        assert all(r.length == 2048 for r in got[:-1]) and [r.start for r in got] == list(range(0, len(ids), 2048))
    check_sequences(P.pack(parts.drop("ids")).collect(), 2048)
    assert P.pack(P.pieces(docs.limit(0), PATH)).count() == 0


def check_sequences(rows, capacity):
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in seqs.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(seqs)


def test_exchange_reaches_the_bound(spark):
    rng = random.Random(2)
    rows = [(i, 0, 0, rng.choice([rng.randint(1, 300), rng.randint(300, 1400), 2048])) for i in range(4000)]
    items = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long")
    got = P.pack(items, partition_pieces=150).collect()
    assert sorted(r.doc_id for r in got) == list(range(4000))
    bound = P.lower_bound(np.array([r[3] for r in rows]), 2048)
    assert bound <= check_sequences(got, 2048) <= bound + 2  # 27 partitions alone would need up to 26 more


def test_one_id_for_all_rows_and_clashing_columns(spark):
    rng = random.Random(3)
    rows = [(None, rng.randint(1, 900), "p", i, None, True) for i in range(10000)]
    items = spark.createDataFrame(rows, "doc_id long, length long, part string, sequence_id long, offset long, open boolean").withColumn("row", items_row())
    got = P.pack(items, partition_pieces=500)
    assert set(got.columns) == set(items.columns)
    rows = got.collect()
    assert len(rows) == 10000 and {r.part for r in rows} == {"p"}
    used, bound = check_sequences(rows, 2048), P.lower_bound(np.array([r.length for r in rows]), 2048)
    assert bound <= used <= bound + 3
    dealt = P._pack_partitions(items.withColumn("n", items_row()), 2048, 20, 0, {"row": "n", "part": "_p", "bin": "_b", "place": "_o", "open": "_x"})
    most = dealt.withColumn("b", dealt["_b"].bitwiseAND((1 << 56) - 1)).selectExpr("shiftright(b, 24) AS p").groupBy("p").count().agg({"count": "max"}).first()[0]
    assert most < 1000


def items_row():
    from pyspark.sql import functions as F

    return F.monotonically_increasing_id()
