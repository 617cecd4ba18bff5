"""Results of the queries that SQL can't say, against plain Python over the smallest tables or over planted rows."""

import difflib
import os
import re
import unicodedata

import numpy as np
import pytest

from loomcast.functions import text_udfs as U
from loomcast.operators import ann as N
from loomcast.operators import cluster as C
from loomcast.plans import registry, steps
from tests.test_oracles import DATA

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
HERE = {
    "FUN-3", "FUN-6", "FUN-18", "FUN-35", "FUN-37", "JON-27", "VEC-1-ANN", "CLU-1", "CLU-1-KMEANS", "CLU-1-WARD", "CLU-2", "CLU-5", "CLU-6", "CLU-8", "CLU-9", "CLU-12", "CLU-22", "CLU-23", "CLU-29",
    "STP-2", "STP-6", "STP-7", "STP-8", "STP-9", "UDF-6", "UDF-7",
}


def run(spark, name):
    from __spark_entry__ import queries

    return queries()[name](spark, DATA).collect()


def table(spark, name):
    return spark.read.parquet(f"{DATA}/{name}.parquet").collect()


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in table(spark, "documents")}


@pytest.fixture(scope="module")
def vectors(spark):
    rows = sorted(table(spark, "embeddings"), key=lambda r: r.vec_id)
    x = np.array([r.embedding for r in rows], float)
    return [r.vec_id for r in rows], np.array([r.label for r in rows]), x / np.linalg.norm(x, axis=1, keepdims=True)


def test_every_query_without_sql_is_tested_here():
    assert set(registry.QUERIES) - set(registry.ORACLES) == HERE


def test_fun_3(spark, texts):
    def clean(t):
        out = unicodedata.normalize("NFKC", t)
        for a, b in (("‘", "'"), ("’", "'"), ("“", '"'), ("”", '"'), ("–", "-"), ("—", "-"), ("…", "...")):
            out = out.replace(a, b)
        kept = []
        for c in out:  # of three and more of a character beyond ASCII in a row one stays
            kept.append(c)
        out, i = "", 0
        while i < len(kept):
            j = i
            while j < len(kept) and kept[j] == kept[i]:
                j += 1
            out += kept[i] * (1 if ord(kept[i]) > 127 and j - i > 2 else j - i)
            i = j
        return " ".join(out.split())

    assert {r.doc_id: r.t for r in run(spark, "FUN-3")} == {i: clean(t) for i, t in texts.items()}


def slow_cap(text):
    words = text.split()
    for n in range(min(6, len(words) // 2), 1, -1):
        out, i = [], 0
        while i < len(words):
            k = 1
            while len(words[i : i + n]) == n and words[i + k * n : i + (k + 1) * n] == words[i : i + n]:
                k += 1
            if k > 2:
                out += words[i : i + n] * 2
                i += k * n
            else:
                out.append(words[i])
                i += 1
        words = out
    return " ".join(words)


def test_fun_6(spark, texts):
    assert {r.doc_id: r.t for r in run(spark, "FUN-6")} == {i: slow_cap(t) for i, t in texts.items()}
    rng = np.random.default_rng(1)
    for _ in range(300):
        t = " ".join(rng.choice(list("abc"), rng.integers(0, 40)))
        assert U.cap_ngram_runs_text(t) == slow_cap(t)
    assert len(U.cap_ngram_runs_text("a b " * 100000).split()) == 4


def test_fun_18(spark, texts):
    def segments(text):
        sentences = [s for s in re.split(r"(?<=[.!?])\s+", text or "") if s.strip()]
        vecs, out, held, words = [U.hashed_vector_of(s) for s in sentences], [], [], 0
        for i, s in enumerate(sentences):
            held.append(i)
            words += len(s.split())
            ahead = vecs[i + 1 : i + 4]
            mean = np.mean([vecs[j] for j in held], axis=0)
            if words >= 120 or words >= 80 and (not ahead or np.mean([v @ mean for v in ahead]) < 0.5):
                out.append((held, words))
                held, words = [], 0
        return [(" ".join(" ".join(sentences[j] for j in h).split()), w) for h, w in out + ([(held, words)] if held else [])]

    got = {}
    for r in sorted(run(spark, "FUN-18"), key=lambda r: (r.id, r.segment)):
        got.setdefault(r.id, []).append((r.text, r.words))
    assert got == {i: segments(t) for i, t in texts.items() if segments(t)}
    same = np.ones((6, 1))
    assert U.segment_ends([50] * 6, same, 80, 200) == [4, 6]  # sentences that cohere go on to the limit
    assert U.segment_ends([50] * 6, np.array([[1.0], [1.0], [-1.0], [-1.0], [1.0], [1.0]]), 80, 500) == [2, 4, 6]


def ratio(a, b):
    return difflib.SequenceMatcher(None, a.lower(), b.lower()).ratio()


def test_fun_35_and_37(spark):
    turns = sorted(table(spark, "conversations"), key=lambda r: (r.conv_id, r.turn))
    want, conf = [], []
    for conv in {r.conv_id for r in turns}:
        for role in ("user", "assistant", "system"):
            own = [r for r in turns if r.conv_id == conv and r.role == role]
            for a, b in zip(own, own[1:]):
                if b.text is None:
                    continue
                near = 0.3 * (abs(len(a.text) - len(b.text)) <= 30) + 0.3 * (b.turn - a.turn <= 2)
                conf.append((conv, a.turn, round(0.4 * ratio(a.text, b.text) + near, 6)))
                if role == "user":
                    want.append((conv, a.turn, round(ratio(a.text, b.text), 6)))
    for name, column, rows in (("FUN-35", "ratio", want), ("FUN-37", "confidence", conf)):
        got = sorted((r.conv_id, r.turn, r[column]) for r in run(spark, name))
        assert [r[:2] for r in got] == [r[:2] for r in sorted(rows)] and [r[2] for r in got] == pytest.approx([r[2] for r in sorted(rows)], abs=2e-6)


def test_jon_27(spark):
    import re

    plain, best = lambda t: re.sub(r"[^\w\s]", "", t.strip(" ").lower()), {}
    pages = [(r.page_id, ".".join(re.search("://([^/?#:]*)", r.url.lower())[1].split(".")[-2:]), plain(re.search("<title>(.*?)</title>", r.html, re.S)[1]), len(r.html)) for r in table(spark, "pages")]
    for i, site, title, n in pages:
        for j, other_site, other, m in pages:
            if i != j and site == other_site and title and other and (x := ratio(title, other)) >= 0.75:
                apart = abs(i - j)
                score = round(x + (0.15 if apart <= 7 else 0.1 if apart <= 14 else 0.05 if apart <= 30 else 0) + 0.1 * (abs(n - m) <= 0.1 * n), 6)
                best[i] = max(best.get(i, (0, 0)), (score, -j))
    got = {r.page_id: (r.score, -r.other_id) for r in run(spark, "JON-27")}
    assert len(best) >= 8 and set(got) == set(best) and all(got[k][0] == pytest.approx(best[k][0], abs=2e-6) for k in best)


@pytest.mark.parametrize("limit", [0.7, 0.75, 0.9])
def test_title_pairs_miss_none(spark, limit):
    import random

    from loomcast.operators.fuzzy import title_pairs

    rng, titles = random.Random(int(limit * 100)), ["a", "ab", "abc", "abcd", "abd", "bd", "aaaa", "aaab", "é", "éa", "abab", "baba"]
    for _ in range(60):
        base = "".join(rng.choices("abcde ", k=rng.randrange(3, 40))).strip() or "x"
        titles += [base, "".join(c for c in base if rng.random() > 0.12) or "y", base[: len(base) // 2] + "zz" + base[len(base) // 2 :]]
    rows = [(i % 2, t) for i, t in enumerate(titles)]
    df = spark.createDataFrame(rows, "key int, title string")
    want = {(k, a, b) for k, a in set(rows) for q, b in set(rows) if k == q and ratio(a, b) >= limit}
    assert {(r.key, r.a, r.b) for r in title_pairs(df, df, limit).collect()} == want


def test_ann_recall(spark, vectors):
    ids, _, x = vectors
    found = {}
    for r in run(spark, "VEC-1-ANN"):
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for i, q in enumerate(ids):
        if q % 20 == 0:
            true = {ids[j] for j in np.argsort(-np.round(x @ x[i], 6), kind="stable")[:10]}
            hits, total = hits + len(true & found[q]), total + 10
    assert hits / total >= 0.9
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 16))
    rows = [(i, (base[i % 40] + 0.3 * rng.normal(size=16)).tolist(), None) for i in range(4000)]
    df = spark.createDataFrame(rows + [(4000, None, None)], "vec_id long, e array<double>, label int")
    cells = N.fit_cells(df, sample=1000)
    asked = df.where("vec_id % 20 = 0 AND e IS NOT NULL").selectExpr("vec_id AS query_id", "e AS qe")
    got = {}
    for r in N.search(N.build(df, cells), asked, cells, 5, visit=8).collect():
        got.setdefault(r.query_id, set()).add(r.id)
    u = np.array([r[1] for r in rows])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    true = {i: set(np.argsort(-(u @ u[i]), kind="stable")[:5].tolist()) for i in range(0, 4000, 20)}
    assert sum(len(true[i] & got[i]) for i in true) / (5 * len(true)) >= 0.9


def test_knn_blocks_are_exact(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_ROWS", 7)
    rng = np.random.default_rng(2)
    u = rng.normal(size=(60, 5))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist(), i % 2) for i, v in enumerate(u)] + [(99, None, 1), (98, u[0].tolist(), None)], "vec_id long, e array<double>, label int")
    sims = np.round(u @ u.T, 6)
    want = set()
    for i in range(60):
        near = sorted((-sims[i, j], j) for j in range(60) if j != i and j % 2 == i % 2 and sims[i, j] >= 0.1)[:3]
        want |= {(i, j, -s) for s, j in near}
    assert {(r.a, r.b, r.sim) for r in C.neighbours(df, 3, 0.1, block="label").collect()} == want


def test_density_and_linkage_queries(spark, vectors):
    from tests.test_density import brute
    from tests.test_features import partition

    ids, _, x = vectors
    assert {r.vec_id: r.cluster for r in run(spark, "CLU-1")} == brute(list(ids), x, 5, 5, 15)
    raw = np.array([r.embedding for r in sorted(table(spark, "embeddings"), key=lambda r: list(ids).index(r.vec_id))], float)
    found = {list(ids).index(r.vec_id): r.cluster for r in run(spark, "CLU-1-WARD")}
    assert len(set(found.values())) == 8 and partition(found) == {frozenset(g) for g in ward_groups(raw, 8)}


def ward_groups(vecs, clusters):
    """Plain linkage by sums, a pair at a time."""
    groups, n, total = {i: [i] for i in range(len(vecs))}, np.ones(len(vecs)), vecs.copy()
    while len(groups) > clusters:
        live = np.array(sorted(groups))
        mean = total[live] / n[live, None]
        cost = n[live, None] * n[live] / (n[live, None] + n[live]) * ((mean**2).sum(1)[:, None] + (mean**2).sum(1) - 2 * mean @ mean.T)
        cost[np.tril_indices(len(live))] = np.inf
        i, j = (live[k] for k in np.unravel_index(int(np.argmin(cost)), cost.shape))
        groups[i] += groups.pop(j)
        n[i], total[i] = n[i] + n[j], total[i] + total[j]
    return groups.values()


def test_k_means_queries(spark, vectors):
    ids, labels, _ = vectors
    for name, ks in (("CLU-1-KMEANS", {5}), ("CLU-2", {2, 3, 4}), ("CLU-8", {1, 4})):
        got = run(spark, name)
        assert sum(r.n for r in got) == len(ids) and len(got) in ks
    got = {}
    for r in run(spark, "CLU-6"):
        got[r.label] = got.get(r.label, 0) + r.n
    assert got == {int(k): int((labels == k).sum()) for k in set(labels.tolist())}
    best = run(spark, "CLU-9")[0]
    assert best.k in range(1, 6) and -1 <= best.silhouette <= 1
    check = run(spark, "CLU-29")[0]
    assert check.k in range(1, 5) and not check.too_few


def planted(spark, sizes, dim=16, spread=0.05):
    """Rows around orthogonal directions, one for each size."""
    rng, rows = np.random.default_rng(3), []
    for g, n in enumerate(sizes):
        for _ in range(n):
            v = np.eye(dim)[g] + spread * rng.normal(size=dim)
            rows.append((len(rows), g, v.tolist(), f"ch{g % 2}", len(rows) % 7, f"{['river', 'stone', 'cloud'][g % 3]} word{len(rows)} text here"))
    return spark.createDataFrame(rows, "segment_id long, truth int, e array<double>, channel string, content_id long, text string")


def pairs_of(rows, a, b):
    return {(r[a], r[b]) for r in rows}


def test_k_means_finds_planted_groups(spark):
    df = planted(spark, [10, 10, 5])
    out, report = C.k_means(df, range(2, 5), least_size=3)
    assert report["k"] == 3 and report["silhouette"] > 0.8 and len(pairs_of(out.collect(), "truth", "cluster")) == 3
    one, report = C.k_means(df, [2, 3], least_size=100)
    assert report["k"] == 1 and {r.cluster for r in one.collect()} == {0}


def brute_align(groups, threshold):
    """groups: [(group, theme, unit vector)] in order; theme groups of two and more, as sets."""
    used, out = set(), []
    for i, (g, _, v) in enumerate(groups):
        if i in used:
            continue
        members, seen = [i], {g}
        for j in sorted(range(len(groups)), key=lambda j: -(groups[j][2] @ v)):
            if j != i and j not in used and groups[j][0] not in seen and groups[j][2] @ v >= threshold:
                members.append(j)
                seen.add(groups[j][0])
        used |= set(members)
        if len(members) > 1:
            out.append(frozenset((groups[m][0], groups[m][1]) for m in members))
    return set(out)


@pytest.mark.parametrize("name", ["CLU-5", "CLU-12"])
def test_alignment(spark, vectors, name):
    ids, labels, x = vectors
    raw = {r.vec_id: np.array(r.embedding, float) for r in table(spark, "embeddings")}
    lang = {r.doc_id: r.lang for r in table(spark, "documents")}
    member = {}
    for i, k in zip(ids, labels.tolist()):
        g = i % 3 if name == "CLU-5" else lang.get(i)
        if g is not None:
            member.setdefault((g, k), []).append(raw[i])
    groups = [(g, k, np.mean(v, axis=0) / np.linalg.norm(np.mean(v, axis=0))) for (g, k), v in sorted(member.items())]
    got, rows = {}, run(spark, name)
    for r in rows:
        if r.aligned is not None:
            got.setdefault(r.aligned, set()).add((r.grp, r.theme))
    assert len(rows) == len(groups)
    assert set(map(frozenset, got.values())) == brute_align(groups, 0.3 if name == "CLU-5" else 0.2)


def test_dense_core(spark, vectors):
    ids, labels, x = vectors
    want = set()
    for k in set(labels.tolist()):
        at = np.flatnonzero(labels == k)
        sims = x[at] @ x[at].T
        core = [int(np.argmax(sims.sum(axis=1)))]
        while True:
            low = sims[:, core].min(axis=1)
            low[core] = -2
            if low.max() < 0.05:
                break
            core.append(int(np.argmax(low)))
        want |= {(int(k), ids[at[i]]) for i in core}
    assert {(r.label, r.vec_id) for r in run(spark, "CLU-22")} == want


def brute_canopies(vecs, names, order, k, tau, beta, sent):
    sims, free, out, found = vecs @ vecs.T, set(range(len(vecs))), {}, 0
    near = [sorted(range(len(vecs)), key=lambda j: (-sims[i, j], j))[: k + 1] for i in range(len(vecs))]
    for anchor in order:
        if anchor not in free:
            continue
        free.discard(anchor)
        out[anchor], members, proto, guards, added = found, [anchor], vecs[anchor], [anchor], 0
        density = np.mean([sims[anchor, j] for j in near[anchor][1:]])
        wait = {j for j in near[anchor] if j in free and sims[anchor, j] >= 0}
        while wait:
            i = sorted(wait, key=lambda j: (-(vecs[j] @ proto), j))[0]
            wait.discard(i)
            fine = vecs[i] @ proto >= max(tau, beta * density) and (names[i] is None or names[i] == names[anchor])
            if fine and len(guards) >= 3:
                fine = sum(vecs[i] @ vecs[g] >= sent for g in guards) >= min(2, max(1, len(guards) // 2))
            if fine:
                free.discard(i)
                out[i] = found
                members.append(i)
                added += 1
                if added == 16:
                    added = 0
                    best = members if len(members) <= 32 else [members[j] for j in np.argsort(-(vecs[members] @ proto), kind="stable")[:32]]
                    proto = np.mean(vecs[best], axis=0)
                    proto = proto / np.linalg.norm(proto)
                    guards = [anchor] if len(members) > 5 else list(members)
                    while len(guards) < min(5, len(members)):
                        rest = [m for m in members if m not in guards]
                        guards.append(max(rest, key=lambda m: (min(vecs[m] @ vecs[g] for g in guards), -members.index(m))))
                wait |= {j for j in near[i] if j in free}
        found += 1
    return out


def test_canopies(spark, vectors):
    ids, labels, x = vectors
    got = {(r.label, r.vec_id): r.canopy for r in run(spark, "CLU-23")}
    for k in sorted(set(labels.tolist())):
        at = np.flatnonzero(labels == k)
        own = [ids[i] for i in at]
        order = sorted(range(len(at)), key=lambda i: (-(own[i] % 13), own[i]))
        names = [f"n{i % 4}" if i % 9 == 0 else None for i in own]
        want = brute_canopies(x[at], names, order, 10, 0.3, 0.6, 0.15)
        assert {own[i]: c for i, c in want.items()} == {i: got[(k, i)] for i in own}


def test_gates():
    v = np.eye(3)[[0, 0, 1]] + 0.0
    assert C.Canopy(0, v, "a", 0.5).verdict(1, None) == "passed" and C.Canopy(0, v, "a", 0.5).verdict(1, "b") == "name"
    assert C.Canopy(0, v, "a", 0.5).verdict(2, None) == "prototype" and C.Canopy(0, v, "a", 2.0).verdict(1, "a") == "density"
    held = C.Canopy(0, np.array([[1.0, 0.0], [0.8, 0.6], [0.8, -0.6], [0.7, 0.714]]), "a", 0.5)
    held.sentinels = [2, 2, 2]
    assert held.verdict(3, None) == "sentinel"


def test_search_step(spark, texts):
    asked = [U.hashed_vector_of(t) for t in steps.default_expand("the and thing", "multi_query", 3)]
    recent = {i: U.hashed_vector_of(t) for i, t in texts.items() if i % 40 <= 30}
    best = {}
    for q, v in enumerate(asked):
        sims = sorted(((-round(float(u @ v), 6), i) for i, u in recent.items()))[:50]
        for s, i in sims:
            key = (i // 3, i % 3 * 10.0)
            if -s >= 0.05 and (key not in best or (q, s, i) < best[key]):
                best[key] = (q, s, i)
    got = {(r.segment_id, r.query_idx): r.sim for r in run(spark, "STP-2")}
    want = {(i, q): -s for q, s, i in best.values()}
    assert len(set(got) & set(want)) >= 0.98 * len(want)  # sums in another order may turn a tie at the sixth digit


def test_theme_steps_on_planted_groups(spark):
    from pyspark.sql import functions as F

    df = planted(spark, [20, 20, 12]).withColumns({"date": F.to_timestamp(F.lit("2024-01-30")), "lang": F.lit("en"), "project": F.lit("p"), "length": F.lit(1.0)})
    base = steps.Context(df, "2024-01-31 00:00:00", "river stone")
    themed = steps.Chain().then("retrieve_all_segments").then("extract_themes", method="kmeans", n_clusters=3).run(base).frames["themed"].collect()
    assert len(pairs_of(themed, "truth", "cluster")) == 3 and -1 not in {r.cluster for r in themed}
    few = steps.Chain().then("retrieve_all_segments").then("extract_themes", method="kmeans", n_clusters=3, min_cluster_size=15).run(base).frames["themed"].collect()
    assert {r.cluster for r in few if r.truth == 2} == {-1}
    check = steps.Chain().then("retrieve_all_segments").then("quick_cluster_check").run(base).frames["themed"].collect()
    assert len(pairs_of(check, "truth", "cluster")) == 3
    alone = steps.Chain().then("quick_cluster_check", skip_if_few_segments=100).run(base).frames["themed"].collect()
    assert {r.cluster for r in alone} == {0}
    sub = steps.Chain().then("retrieve_all_segments").then("extract_themes", method="kmeans", n_clusters=2).then("extract_subthemes", n_subthemes=2, require_valid_clusters=False).run(base).frames["subthemed"].collect()
    assert len(sub) == 52 and len({(r.cluster, r.subtheme) for r in sub}) == 4
    whole = steps.Chain().then("retrieve_all_segments").then("analyze_themes_with_subthemes", select_segments_per_subtheme=4).run(base).frames
    chosen = whole["selected"].collect()
    assert len(chosen) == 12 and {r.picked for r in chosen} == {1, 2, 3, 4}
    assert {r["name"].split(", ")[0] for r in whole["theme_names"].collect()} <= {"cloud", "here", "river", "stone", "text"}


def test_theme_queries_hold_every_row(spark, texts):
    ids = {r.vec_id for r in table(spark, "embeddings")}
    able = {i for i in texts if i % 40 <= 30 and i in ids}
    for name in ("STP-7", "STP-8", "STP-9"):
        assert sum(r.n for r in run(spark, name)) == len(able), name
    picked = run(spark, "STP-6")
    assert {r.segment_id for r in picked} <= able and all(1 <= r.picked <= 8 for r in picked)
    for cluster in {r.cluster for r in picked}:
        assert sorted(r.picked for r in picked if r.cluster == cluster) == list(range(1, 1 + sum(r.cluster == cluster for r in picked)))
    said = run(spark, "UDF-6")
    assert said and all(r.n_chars > 0 for r in said)


def test_default_embedding_has_unit_length(spark, texts):
    want = {i: round(float(U.hashed_vector_of(t) @ U.hashed_vector_of(t)), 4) for i, t in texts.items()}
    assert {r.doc_id: r.norm for r in run(spark, "UDF-7")} == want
