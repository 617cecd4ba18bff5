"""Writing the text index: postings are made once, whole texts, of any batch; a frequent word's are spread."""

import re

from loomcast.operators import textindex as T


def test_postings_of_joined_texts(spark, monkeypatch):
    monkeypatch.setattr(T, "WORDS_AT_ONCE", 5)
    texts = {1: "a b A, c", 2: None, 3: "", 4: "b", 5: "Ä_1 x x y x z a a", 6: "...", 7: "a"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    got = {(r.term, r.id): (r.length, r.positions) for r in T.postings(df, "doc_id", "text").collect()}
    want = {}
    for i, t in texts.items():
        words = re.findall(r"\w+", (t or "").lower())
        for w in words:
            want[w, i] = (len(words), [k for k, x in enumerate(words) if x == w])
    assert got == want


def test_index_is_made_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(300).selectExpr("id AS doc_id", "concat('the w', id) AS text").repartition(3).mapInArrow(counted, "doc_id long, text string")
    T.write_index(df, str(tmp_path))
    assert seen.value == 600  # once for the postings, once for the totals
    the = spark.read.parquet(f"{tmp_path}/postings").where("term = 'the'")
    assert the.selectExpr("inline(at)").count() == 300 and len(the.inputFiles()) > 1
    asked = spark.createDataFrame([(0, ["the", "w7"]), (1, ["W9"])], "query_id int, terms array<string>")
    found = T.search_index(spark, str(tmp_path), asked, every=True)
    assert sorted((r.query_id, r.doc_id) for r in found.collect()) == [(0, 7), (1, 9)]
