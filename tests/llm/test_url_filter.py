import pytest

from loomcast.llm import url_filter as U

RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]


def brute_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:n])
    rest = rest[n:]
    n = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return host, rest[:n]


def brute_rule(host, path):
    fits = []
    for action, rule in RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), rule, action))
    return max(fits)[1:] if fits else (None, None)


URLS = [
    "http://A.Example.COM/en/7?x=1", "https://example.com/en/8", "http://com/en/", "http://xcom/en/1", "http://a.net/de/8", "http://m.example.net/de/8#t",
    "http://q.example.org/es/1", "HTTP://q.org/fr?u=http://z.com/en/", None, "", "no scheme", "x://", "x:///p", "http://h?q/e", "http://É.com/en/É?a", "a://b.com#/en/",
    "http://sub.example.com/en/7" + "7" * 5000, "http://u.org/es/\n2",
]


def test_splits_and_rules(spark):
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    outcomes = spark.createDataFrame([], "url string, bad boolean")
    got = {r.page_id: r for r in U.judge(df, outcomes, RULES).collect()}
    for i, u in enumerate(URLS):
        host, path = brute_split(u)
        rule, action = brute_rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, action or "allow"), u
    table = spark.createDataFrame(RULES, "action string, rule string")
    joined = {r.page_id: (r.rule, r.rule_action) for r in U.match_rule_table(U.split_url(df.drop("host"), "url"), table).collect()}
    assert joined == {i: brute_rule(*brute_split(u)) for i, u in enumerate(URLS)}
    assert U.judge(df.limit(0), outcomes, RULES).count() == 0
    many = RULES + [("block", f"h{i}.zz/") for i in range(2100)]
    for rules in (table, many):
        assert {r.page_id: (r.rule, r.verdict) for r in U.judge(df, outcomes, rules).collect()} == {i: (r.rule, r.verdict) for i, r in got.items()}


def test_domains(spark):
    want = {
        "a.b.example.com": ("example.com", "com"), "x.example.co.uk": ("example.co.uk", "co.uk"), "example.co.uk": ("example.co.uk", "co.uk"), "co.uk": ("co.uk", "uk"),
        "www.com.au:8080": ("www.com.au", "com.au"), "t.co": ("t.co", "co"), "localhost": ("localhost", "localhost"), "10.1.2.3": ("10.1.2.3", "10.1.2.3"), "": ("", ""), "a.com.example.net": ("example.net", "net"),
    }
    df = spark.createDataFrame([(h,) for h in want], "host string")
    domain, suffix = U.domain_of(df.host)
    assert {r.host: (r.d, r.s) for r in df.select("host", domain.alias("d"), suffix.alias("s")).collect()} == want


def test_shrinks_little_evidence_and_blocks_much(spark):
    rows = [("http://bad.example.com/1", True)] * 60 + [("http://good.example.com/1", False)] * 80 + [("http://new.example.com/1", True), ("http://x.org/", False), ("http://x.org/", None)]
    outcomes = spark.createDataFrame(rows, "url string, bad boolean")
    pages = spark.createDataFrame([(1, "http://bad.example.com/z"), (2, "http://good.example.com/z"), (3, "http://new.example.com/z"), (4, "http://unseen.net/"), (5, None)], "page_id long, url string")
    got = {r.page_id: r for r in U.judge(pages, outcomes, []).collect()}
    assert [got[i].verdict for i in range(1, 6)] == ["block", "allow", "allow", "allow", "allow"]
    assert got[1].n_labelled == 60 and got[4].n_labelled == 0 and 0.3 < got[3].bad_rate < 0.95


def test_rates_match_a_plain_computation(spark):
    counts = {"a.x.com": (10, 4), "b.x.com": (5, 0), "c.y.com": (40, 30), "z.org": (7, 1)}
    rows = [(f"http://{h}/", i < bad) for h, (n, bad) in counts.items() for i in range(n)]

    def strength(gs):
        k, n, y = len(gs), sum(g[0] for g in gs), sum(g[1] for g in gs)
        p = y / n
        s2 = k * sum(a * (b / a - p) ** 2 for a, b in gs) / ((k - 1) * n) if k > 1 else 0
        e = s2 - p * (1 - p) * sum(1 / a for a, _ in gs) / k
        return (max(1.0, min(1e4, (p * (1 - p) - s2) / e)) if k > 1 and e > 0 else 1e4), p

    def level(parts):
        out = {}
        for h, (n, b) in counts.items():
            key = ".".join(h.split(".")[-parts:])
            a, c = out.get(key, (0, 0))
            out[key] = (a + n, c + b)
        return out

    suf, dom = level(1), level(2)
    (ms, p), (md, _), (mh, _) = strength(list(suf.values())), strength(list(dom.values())), strength(list(counts.values()))
    rs = {k: (b + ms * p) / (n + ms) for k, (n, b) in suf.items()}
    rd = {k: (b + md * rs[k.split(".")[-1]]) / (n + md) for k, (n, b) in dom.items()}
    want = {h: (b + mh * rd[".".join(h.split(".")[-2:])]) / (n + mh) for h, (n, b) in counts.items()}
    df = U.split_url(spark.createDataFrame(rows, "url string, bad boolean"), "url")
    got = {r.host: r.bad_rate for r in U.reputations(df).collect()}
    assert got == pytest.approx(want)


def test_hosts_without_outcomes_take_their_domains_rate(spark):
    rows = [(f"http://h{i}.bad.com/", True) for i in range(30) for _ in range(20)] + [(f"http://h{i}.good{i}.com/", False) for i in range(30) for _ in range(20)]
    rows += [(f"http://d{i}.xx/", True) for i in range(30) for _ in range(20)] + [(f"http://d{i}.org/", False) for i in range(30) for _ in range(60)]
    outcomes = spark.createDataFrame(rows, "url string, bad boolean")
    pages = spark.createDataFrame([(1, "http://new.bad.com/"), (2, "http://new.good3.com/"), (3, "http://never.xx/"), (4, "http://a.unknown/"), (5, None)], "page_id long, url string")
    got = {r.page_id: (r.verdict, r.n_labelled) for r in U.judge(pages, outcomes, []).collect()}
    assert got == {1: ("block", 0), 2: ("allow", 0), 3: ("block", 0), 4: ("allow", 0), 5: ("allow", 0)}


def test_clashing_columns_are_kept(spark):
    outcomes = spark.createDataFrame([("http://a.com/", True), ("http://b.com/", False)], "url string, bad boolean")
    names = ("__n", "__host", "__m", "__domain", "__all", "__sr", "__h", "__p", "best", "bad", "domain", "suffix", "a.b")
    pages = spark.createDataFrame([(1, "http://a.com/x", *names), (2, None, *names)], "page_id long, url string, " + ", ".join(f"`{n}` string" for n in names))
    for rules in ([("block", "a.com/")], spark.createDataFrame([("block", "a.com/")], "action string, rule string")):
        got = {r.page_id: r for r in U.judge(pages, outcomes, rules).collect()}
        assert got[1].verdict == "block" and got[2].verdict == "allow" and all(got[1][n] == n for n in names)
    both = spark.createDataFrame([(1, "http://a.com/x", "mine", "theirs")], "page_id long, url string, rule_action string, Host string")
    assert [(r.host, r.verdict) for r in U.judge(both, outcomes, [("block", "a.com/")]).collect()] == [("a.com", "block")]
