"""Terms of short and long texts, and what a task hands on."""

from collections import Counter

from loomcast.llm import divergence as D


def test_short_texts_are_taken_at_once(monkeypatch):
    calls = []
    pattern = D._TERM

    class Seen:
        def findall(self, text):
            calls.append("all")
            return pattern.findall(text)

        def finditer(self, text):
            calls.append("each")
            return pattern.finditer(text)

    monkeypatch.setattr(D, "_TERM", Seen())
    text = "Ab-aB é1x ÀÀ".encode()
    assert [w for part in D._words(text) for w in part] == [b"ab", b"ab", "é".encode(), b"x", "ÀÀ".encode()] and calls == ["all"]
    assert list(D._words(b"1 2")) == []
    monkeypatch.setattr(D, "WORDS_AT_ONCE", 4)
    assert [w for part in D._words(text) for w in part] == [b"ab", b"ab", "é".encode(), b"x", "ÀÀ".encode()] and calls[-1] == "each"


def test_counts_are_equal_however_often_they_are_handed_on(spark, monkeypatch):
    texts = [("en", "a", "one two two"), ("en", "b", None), (None, "a", "Two é"), ("en", "a", "two 12"), ("fr", None, "")]
    docs = spark.createDataFrame(texts, "lang string, source string, text string").coalesce(1)
    want = {}
    for lang, source, text in texts:
        words = [w.decode() for part in D._words((text or "").encode()) for w in part]
        want[lang or "", source or "", None] = (0, 0)
        for w, n in Counter(words).items():
            old = want.get((lang or "", source or "", w), (0, 0))
            want[lang or "", source or "", w] = (old[0] + n, old[1] + 1)
    assert {tuple(r[:3]): tuple(r[3:]) for r in D.term_counts(docs).collect()} == want
