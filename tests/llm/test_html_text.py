import random
import re
import time
from os.path import commonprefix

from pyspark.sql import functions as F

from loomcast.llm import html_text as H


def lcs_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(400):
        a, b = ([rng.choice("abcdef") for _ in range(rng.randint(0, 14))] for _ in range(2))
        at = sorted(H.shared_lines(a, b))
        assert len(at) == lcs_length(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in at)


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t="</p><article>x</article>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href="/a">menu</a></li></ul></nav><!-- ad <article>no</article> --><div class="ad">Buy</div>
<div id="cookie-notice">We use cookies<div>nested</div></div>
<article><h1>Title &quot;x&quot; &lt;3 &copy; &eacute;</h1><p><b>First line.<br><p>a  b
	c&nbsp;d <i>it</i>al<a href='x>y'>ic</a></p><p class="promo">Promo</p><ul><li>one<li>two</ul>
<aside>side</aside><pre>x
y</pre><p>5 &lt; 6 &amp; 7 &#x41;&#66; &amp</p><form>f <input value="v"></form><section class="comments"><p>reader said</p></section></article>
<div class="sidebar">s</div><footer>&copy; me</footer></body></html>"""
TEXT = 'Title "x" <3 © é\n\nFirst line.\n\na b c d italic\n\none\n\ntwo\n\nx y\n\n5 < 6 & 7 AB &'


def lines_of(page):
    return [x for x, _ in H.page_lines(page)]


def test_structure():
    assert "\n\n".join(lines_of(PAGE)) == TEXT
    for odd in ("", "<", "<p", "text", "<p>a<!-- open", "<script>never closed", '<a href="unclosed>x', "</p></div>", "a < b", "<article>" * 3000 + "deep"):
        H.page_lines(odd)
    assert lines_of("a < b <p>c") == ["a < b", "c"]


def test_an_article_keeps_its_own_headers_and_paragraphs():
    page = """<nav>m</nav><article><div class="article-header"><h1>Title</h1></div><p id="share-price">Shares rose</p><header><h2>T2</h2></header><p>b</p>
    <div class="share">Share me</div><p class="comments">c1</p><footer>f</footer><div id="related">r</div><nav>n</nav></article><div class="share-buttons">s</div><div class="site-header">h</div>"""
    assert lines_of(page) == ["Title", "Shares rose", "T2", "b"]
    loose = '<div class="article-header"><h1>Title</h1></div><p id="share-price">p</p><div class="main-nav">n</div><ul id="social_links"><li>x</ul><div class="page-banner">b</div>'
    assert lines_of(loose) == ["Title", "p"]


def test_odd_pages_take_time_in_proportion():
    def seconds(page):
        start = time.perf_counter()
        H.page_lines(page)
        return time.perf_counter() - start

    for page in ("<div>" * 60000 + "</span>" * 60000, "<title>x" * 60000, "<p>x" * 60000, "<svg>" * 60000):
        assert seconds(page) < 3, page[:8]
    a = [f"l{i % 997}" for i in range(6000)]
    start = time.perf_counter()
    assert len(H.shared_lines(a, a[5:] + a[:5])) >= 5995
    assert time.perf_counter() - start < 5


def brute_extract(rows):
    """Each page's text, with pairs chosen over one sorted list of urls."""
    parsed = [(i, u, H.page_lines(h or "")) for i, u, h in rows]
    def split(u):
        m = re.match(r"^.*?://([^/?#]*)([^?#]*)", u or "", re.S)
        return (m[1].lower(), m[2]) if m else ("", "")

    able = {}
    for i, u, lines in parsed:
        loose = [x for x, inside in lines if not inside]
        if loose and split(u)[0]:
            able.setdefault((*split(u), u), []).append((i is None, i or 0, loose))
    order = sorted(able)
    out = []
    for i, u, lines in parsed:
        key, pair = (*split(u), u), None
        if key in able and any(not inside for _, inside in lines):
            at = order.index(key)
            near = [k for k in order[max(0, at - 1) : at] + order[at + 1 : at + 2] if k[0] == key[0]]
            if near:
                best = max(near, key=lambda k: len(commonprefix([k[1], key[1]])))
                pair = min(able[best])[2]
        out.append((i, u, "\n\n".join(H.kept_lines([x for x, _ in lines], [n for n, (_, inside) in enumerate(lines) if not inside], pair))))
    return sorted(out, key=str)


def test_matches_brute_force_at_any_number_of_partitions(spark):
    rng = random.Random(4)
    page = "<div>Welcome to {h}</div><div>Topic {t}</div><p>Body of {i}</p><p>Words {w}</p><div>Bottom of {h}</div>"
    rows = []
    for i in range(64):
        rows.append((i, f"http://one.com/a/{rng.randint(0, 40)}", page.format(h="one", t=i % 3, i=i, w=i % 5)))
    for i in range(64, 120):
        h = f"h{rng.randint(0, 9)}.org"
        rows.append((i, f"http://{h}/{rng.choice('ab')}/{rng.randint(0, 9)}?q={rng.randint(0, 2)}", page.format(h=h, t=i % 3, i=i, w=i % 5) if i % 4 else f"<article><p>Art {i}</p></article>"))
    rows += [(200, None, rows[0][2]), (201, "no scheme", rows[0][2]), (202, "http://lone.com/", rows[0][2]), (202, "http://lone.com/", rows[0][2]), (203, "x", None), (None, "http://one.com/a/z", rows[5][2])]
    rows.append((204, "http://one.com/a/long", "<div>Welcome to one</div>" + "".join(f"<p>line {i}</p>" for i in range(20000))))
    want = brute_extract(rows)
    assert sum("Welcome to one" in t for i, u, t in want if u and u.startswith("http://one.com")) == 0
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(0)).withColumn("host", F.lit("h"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in (1, 4, 64):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            got = H.extract(df.repartition(parts)).collect()
            assert sorted(((r.page_id, r.url, r.text) for r in got), key=str) == want, parts
            assert all(r.n_chars == len(r.text) for r in got)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert H.extract(df.limit(0)).count() == 0


def test_differencing_decides_outside_an_article(spark):
    page = "<div>Menu</div><p>Headline {0}</p><article><p>Shared</p><p>Body {0}</p></article><p>Note {0}</p><p>Bottom</p>"
    df = spark.createDataFrame([(i, f"http://h.com/{i}", page.format(i)) for i in range(5)], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in H.extract(df).collect()} == {i: f"Headline {i}\n\nShared\n\nBody {i}\n\nNote {i}" for i in range(5)}


#: Pages and their texts, written by hand.
GOLDEN = [
    ("<main><div id='comments-2'>cc</div><div class='comment-list'><p>reader</p></div><div class='ad-slot'>buy</div><div class='cookie-banner'>cookies</div><p>ok</p></main>", "ok"),
    ("<article><p>One</p><div class='comments-area'>r</div><section id='comment-17'>r</section><aside>s</aside><div class='ad-container'>b</div><p>Two</p></article>", "One\n\nTwo"),
    ("<article><div id='comment-on-policy'><p>The minister's comment.</p></div><p class='ad-hoc'>Ad hoc work</p></article>", "The minister's comment.\n\nAd hoc work"),
    ("<p>Energy is <math><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup></math> here</p>", "Energy is E=mc2 here"),
    ("<article><p>Press <button>Start</button> now</p></article>", "Press Start now"),
    ("<main><h1>Title</h1><p>Body &amp; more</p><form><p>Your mail</p></form></main><footer>f</footer>", "Title\n\nBody & more"),
    ("<article><header><h1>Head</h1></header><p>Text</p><div class='newsletter-box'>Join</div></article>", "Head\n\nText"),
]


def test_golden_pages(spark):
    df = spark.createDataFrame([(i, f"http://h{i}.com/", page) for i, (page, _) in enumerate(GOLDEN)], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in H.extract(df).collect()} == {i: text for i, (_, text) in enumerate(GOLDEN)}


def test_differencing_decides_main(spark):
    page = "<main><p>Share this story</p><p>Story {0}</p><div>All rights reserved</div></main>"
    df = spark.createDataFrame([(i, f"http://h.com/{i}", page.format(i)) for i in range(4)], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in H.extract(df).collect()} == {i: f"Story {i}" for i in range(4)}
