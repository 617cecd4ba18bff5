"""Cases that the driver's tables don't hold: nulls, ties, edges, formats, streams."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from loomcast.functions import predicates as P
from loomcast.functions import scores as S
from loomcast.functions import text as X
from loomcast.functions import text_udfs as U
from loomcast.operators import aggregates as A
from loomcast.operators import cluster as C
from loomcast.operators import joins as J
from loomcast.operators import ranges as R
from loomcast.operators import search as Q
from loomcast.operators import sets as Sets
from loomcast.operators import windows as W
from loomcast.plans import steps
from loomcast.sources import readers, sinks
from loomcast.streaming import streams


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_array_and_json_conditions(spark):
    df = spark.createDataFrame([(1, ["a", None]), (2, []), (3, None), (4, ["b"])], "id int, p array<string>")
    assert rows(df.where(P.overlaps("p", ["b", "c"])), "id") == [(4,)]
    assert rows(df.where(~P.overlaps("p", ["b"])), "id") == [(1,), (2,), (3,)]  # null is no match, not unknown
    js = spark.createDataFrame([(1, '{"a": null}'), (2, '{"b": 1}'), (3, "x"), (4, None)], "id int, j string")
    assert rows(js.where(P.json_has_key("j", "a")), "id") == [(1,)]
    assert rows(js.where(P.json_equals("j", "b", "1")), "id") == [(2,)]
    assert rows(df.where(P.access_allowed(F.array(F.lit("x")), F.array().cast("array<string>"))), "id") == [(1,), (2,), (3,), (4,)]


def test_gap_is_strictly_below_share(spark):
    at = [("2024-01-01", i) for i in range(10)] + [("2024-01-02", i) for i in range(10)]
    source = spark.createDataFrame([(n, d) for n, (d, _) in enumerate(at)], "id int, at string").withColumn("at", F.to_timestamp("at"))
    cache = source.where("id < 9 OR id BETWEEN 10 AND 17")
    assert [(str(r.day), r.n_cache) for r in A.gap_days(source, cache, "at", "at").collect()] == [("2024-01-02", 8)]
    new = sinks.refresh_window(cache.withColumn("up", F.col("at")), source.withColumn("up", F.col("at")), "id", "at", "up", "2024-01-03 00:00:00", 5, 1)
    assert {r.id for r in new.collect()} == set(range(9)) | set(range(10, 20))  # exactly 90 % is no gap


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, None, 2)], "k int, v string, n int")
    new = spark.createDataFrame([(2, "b", 5), (3, None, 7)], "k int, v string, n int")
    assert rows(sinks.upsert(old, new, ["k"]), "k", "n") == [(1, 1), (2, 5), (3, 7)]
    assert rows(sinks.upsert(old, new, ["k"], keep_old=["v"], counters=["n"]), "k", "n") == [(1, 1), (2, 7), (3, 7)]
    assert rows(sinks.insert_new(old, new, ["k"]), "k", "n") == [(1, 1), (2, 2), (3, 7)]


def test_overlap_nearest_and_zero_length(spark):
    words = spark.createDataFrame([(1, 1, 0.0, 1.0), (1, 2, 5.0, 5.0), (1, 3, 130.0, 131.0), (2, 4, 0.0, 1.0)], "c int, w int, ws double, we double")
    spans = spark.createDataFrame([(1, "A", 0.0, 0.5), (1, "B", 0.5, 1.0), (1, "C", 7.0, 120.0)], "c int, who string, ss double, se double")
    got = {r.w: (r.who, round(r.confidence, 3)) for r in J.overlap_else_nearest(words, spans, "c", "w", ("ws", "we"), ("ss", "se"), "who").collect()}
    assert got == {1: ("A", 0.8), 2: ("C", 0.6), 3: ("C", 0.3)}  # a tie goes to the least label; content 2 has no span
    assert J.best_overlap(words, spans, "c", "w", ("ws", "we"), ("ss", "se"), "who", width=0.3).count() == 1


def test_interval_pairs_are_counted_once(spark):
    a = spark.createDataFrame([(1, 1, 0.0, 500.0)], "c int, i int, s double, e double")
    b = spark.createDataFrame([(1, 2, 10.0, 490.0)], "c int, j int, x double, y double")
    for width in (1.0, 60.0, 1000.0):
        assert rows(J.interval_overlaps(a, b, "c", ("s", "e"), ("x", "y"), width), "i", "j", "overlap") == [(1, 2, 480.0)]
        assert J.context_window(a, b, "c", ("s", "e"), ("x", "y"), 20, width).count() == 1


def test_windows(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(["a", None, None, "b", "a", "b", "a"])], "k int, i int, v string")
    assert [r.run for r in W.runs(df, ["k"], ["i"], "v").orderBy("i").collect()] == [1, 2, 2, 3, 4, 5, 6]
    assert [r.v for r in W.absorb_interruptions(df, ["k"], ["i"], "v").orderBy("i").collect()] == ["a", None, None, "b", "b", "a", "a"]
    ranks = W.competition_rank(spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 1.0), (4, None)], "i int, s double"), "s")
    assert rows(ranks.where("s IS NOT NULL"), "i", "rank") == [(1, 1), (2, 1), (3, 3)]


def test_sets_keep_the_first_of_ties(spark):
    a = spark.createDataFrame([(1, 0.5, "a"), (2, 0.1, "a")], "k int, s double, f string")
    b = spark.createDataFrame([(1, 0.5, "b"), (2, 0.9, "b")], "k int, s double, f string")
    assert rows(Sets.union_keep_best([a, b], "k", "s"), "k", "f") == [(1, "a"), (2, "b")]
    assert rows(Sets.union_keep_first([b, a], ["k"], [F.col("s")]), "k", "f") == [(1, "b"), (2, "b")]


def test_text(spark):
    one = spark.range(1)
    value = lambda c: one.select(c.alias("x")).first().x
    assert value(X.cap_word_runs(F.lit("no No no NO yes"))) == "no No no yes"
    assert value(X.truncate_description(F.lit("ab " * 100))) == ("ab " * 66).strip() + "..."
    assert value(X.iso_duration(F.lit("PT1H2M3S"))) == 3723 and value(X.iso_duration(F.lit("1H"))) is None
    assert value(X.clock_duration(F.lit("1:02:03"))) == 3723 and value(X.clock_duration(F.lit("x"))) is None
    assert tuple(value(X.version_parts(F.lit("stitch_v14.2")))) == (14, 2) and value(X.version_parts(F.lit("v1"))) is None
    assert value(X.citations(F.lit("a [1] b [x] [12]"))) == [1, 12]
    assert value(X.join_tokens(F.array(*map(F.lit, ["Hi", ",", "(", "you", ")", "!"])))) == "Hi, (you)!"
    assert value(X.is_contentless(F.lit("...!?"))) and not value(X.is_contentless(F.lit("été")))
    assert U.cap_ngram_runs_text("a b a b a b c c c c") == "a b a b c c c c"
    assert U.clean_artifacts_text("“ﬁne”…  ああああ") == '"fine"... あ' and U.title_ratio("Abc", "aBC") == 1.0


def test_ranges(spark):
    df = spark.createDataFrame([([(3.0, 4.0), (0.0, 1.0), (1.0, 2.0)],), ([],)], "r array<struct<a:double,b:double>>")
    got = [[tuple(x) for x in r.m] for r in df.select(R.merge_ranges(F.col("r")).alias("m")).collect()]
    assert got == [[(0.0, 2.0), (3.0, 4.0)], []]
    plan = spark.range(1).select(R.chunk_plan(F.lit(600.0), 300.0, 2.0).alias("p")).first().p
    assert [tuple(x) for x in plan] == [(0.0, 300.0), (298.0, 600.0)]  # the last four seconds join the chunk before


def test_scores(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0)], "i int, x double")
    assert rows(S.min_max(df, "x", "y"), "y") == [(0.5,), (0.5,)]
    state = spark.createDataFrame([(True, True, False), (True, False, True), (None, None, None)], "a boolean, b boolean, z boolean")
    assert [r.s for r in state.select(S.state_from_flags([("a", "A"), ("b", "B")], "z").alias("s")).collect()] == ["B", "BLOCKED", "NEW"]


def test_graphs_and_selection(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (9, 8), (3, 7)], "a long, b long")
    assert rows(C.connected_components(edges), "node", "component") == [(3, 3), (4, 3), (5, 3), (7, 3), (8, 8), (9, 8)]
    v = spark.createDataFrame([(1, 0.9, [1.0, 0.0]), (2, 0.8, [1.0, 0.0]), (3, 0.5, [0.0, 1.0]), (4, 0.4, None)], "segment_id int, s double, e array<double>")
    assert rows(Q.diverse(v, "s", "e", "segment_id", 2), "segment_id", "picked") == [(1, 1), (3, 2)]
    assert Q.diverse(v, "s", "e", "segment_id", 9).count() == 4  # no more rows than asked for: all come back
    many = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(5)], "query_id int, qe array<double>")
    old, Q.QUERY_BLOCK = Q.QUERY_BLOCK, 2
    try:
        assert Q.scored(v, many, "segment_id").count() == 15
    finally:
        Q.QUERY_BLOCK = old


def test_steps_reject_what_they_do_not_know():
    for bad in ("no_such_step", "rerank_segments"):
        with pytest.raises(ValueError):
            steps.Chain().then(bad, colour=1)
    assert {name for chain in steps.PRESETS.values() for name, _ in chain} <= set(steps.STEPS)
    assert all(steps.preset(name).steps for name in steps.PRESETS)
    assert len(steps.PRESETS) == 9


def test_readers(spark, tmp_path):
    p = str(tmp_path)
    with open(f"{p}/s.csv", "w") as f:
        f.write("name,platform,url,project\nA,x,http://a/,p\nB,y,HTTP://B,q\n")
    src = readers.csv_sources(spark, f"{p}/s.csv")
    assert rows(readers.new_sources(src, [src.where("name = 'B'").withColumn("url", F.lit("http://b/"))]), "name") == [("A",)]
    with open(f"{p}/t.csv", "w") as f:
        f.write("theme_id,theme,subtheme_id,subtheme\n1,T,1a,x\n1,T,1b,y\n2,U,,\n")
    assert [(r.theme_id, len(r.subthemes)) for r in readers.csv_themes(spark, f"{p}/t.csv").orderBy("theme_id").collect()] == [("1", 2), ("2", 0)]
    os.mkdir(f"{p}/tr")
    doc = {"content_id": "c", "chunk_index": 1, "segments": [{"start": 0.0, "end": 1.5, "text": "hi"}]}
    with gzip.open(f"{p}/tr/c_1.json.gz", "wt") as f:
        json.dump(doc, f, indent=1)
    assert rows(readers.transcripts(spark, f"{p}/tr"), "content_id", "end", "text") == [("c", 1.5, "hi")]
    assert rows(readers.discover(spark, f"{p}/tr", r"/(\w+)_(\d+)\.json\.gz$"), "content_id", "chunk") == [("c", 1)]
    with open(f"{p}/a.vtt", "w") as f:
        f.write("WEBVTT\n\n00:01.000 --> 00:02.500 align:start\nHello <b>you</b>\nthere\n\n01:00:00.000 --> 01:00:01.000\nBye\n")
    assert rows(readers.subtitles(spark, f"{p}/a.vtt"), "n", "start", "end", "text") == [(0, 1.0, 2.5, "Hello you there"), (1, 3600.0, 3601.0, "Bye")]
    with open(f"{p}/n.yaml", "w") as f:
        f.write("Jane Doe:\n  - J. Doe\n  - 'Doe'\nBob:\n  - Bobby\n")
    assert rows(readers.aliases(spark, f"{p}/n.yaml"), "alias", "name") == [("Bobby", "Bob"), ("Doe", "Jane Doe"), ("J. Doe", "Jane Doe")]
    pages = spark.createDataFrame([(1, "<li>1. A by B</li><li>2. C by D</li>")], "id int, h string")
    assert rows(readers.chart_rows(pages, "h", r"<li>(\d+)\. (\w+) by (\w+)</li>"), "rank", "name", "creator") == [(1, "A", "B"), (2, "C", "D")]
    sinks.write_csv_gz(src, f"{p}/out")
    assert spark.read.csv(f"{p}/out", header=True).count() == 2
    sinks.write_partitioned(src, f"{p}/parts", "project")
    sinks.write_partitioned(src.where("project = 'p'").limit(0), f"{p}/parts", "project")
    assert readers.keep(spark.read.parquet(f"{p}/parts"), f"{p}/kept").count() == 2
    assert readers.window_table(spark, {7: f"{p}/kept", 30: f"{p}/parts"}, 10).count() == 2


def test_streams(spark, tmp_path):
    p = str(tmp_path)
    data = [(1, 0, "a", 1.0), (1, 10, "a", 1.0), (1, 4000, "b", 1.0), (2, 5, "a", 2.0), (1, 4100, "b", 1.0)]
    df = spark.createDataFrame(data, "k long, s long, v string, value double").withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("s")))
    df.coalesce(1).write.parquet(f"{p}/in")
    read = lambda: streams.read_files(spark, f"{p}/in", df.schema)
    hours = streams.run_once(streams.tumbling_counts(read(), "ts", "v"), "hours", "complete", f"{p}/c1")
    assert sorted((r.v, r.n) for r in hours.collect()) == [("a", 3), ("b", 2)]
    allowed = streams.run_once(streams.rate_limiter(read(), "k", "ts", 1), "rates", "append", f"{p}/c2")
    assert sorted((r.k, round(r.at_s) - 1_700_000_000, r.allowed) for r in allowed.collect()) == [(1, 0, True), (1, 10, False), (1, 4000, True), (1, 4100, False), (2, 5, True)]
    turns = streams.run_once(streams.speaker_turns(read(), "k", "ts", "v"), "turns", "append", f"{p}/c3")
    assert [(r.k, r.v) for r in turns.collect()] == [(1, "a")]
    bad = read().withColumn("bad", F.col("v") == "a")
    failures = streams.run_once(streams.failure_tracker(bad, "k", "ts", "bad", most=2), "failures", "update", f"{p}/c4")
    assert {r.k: r.paused_until > 0 for r in failures.collect()} == {1: True, 2: False}
    dd = streams.run_once(streams.deduplicated(read(), "ts", ["k", "v"], "2 hours"), "dd", "append", f"{p}/c5")
    assert dd.count() == 3
    sink = streams.window_table_sink(f"{p}/win", "k", "ts", 7, lambda: "2023-11-15 12:00:00")
    sink(df.where("k = 2"), 0)
    sink(df.where("k = 1"), 1)
    sink(df.where("k = 1"), 1)  # run again: the same state
    assert rows(spark.read.parquet(f"{p}/win/state=1"), "k", "s") == [(1, 4100), (2, 5)]


def test_stream_windows_and_joins(spark, tmp_path):
    p = str(tmp_path)
    schema = "k long, s long, value double"
    at = F.timestamp_seconds(F.lit(1_700_000_000 // 3600 * 3600) + F.col("s"))
    left = spark.createDataFrame([(1, 0, 1.0), (1, 600, 1.0), (1, 4000, 1.0), (2, 30000, 1.0), (9, 900000, 0.0)], schema).withColumn("ts", at)
    left.coalesce(1).write.parquet(f"{p}/a")
    spark.createDataFrame([(1, 700, 2.0), (1, 9000, 3.0), (2, 29000, 4.0)], schema).withColumn("ts", at).coalesce(1).write.parquet(f"{p}/b")
    read = lambda x: streams.read_files(spark, f"{p}/{x}", left.schema)
    slide = streams.run_updates(streams.sliding_counts(read("a").where("k < 9"), "ts", "k", "2 hours", "1 hour", "1 day"), f"{p}/u1", ["start", "k"])
    assert sorted((r.k, r.n) for r in slide.collect()) == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 1)]
    held = streams.run_once(streams.sessions(read("a"), "ts", "k", "20 minutes", "1 minute"), "held", "append", f"{p}/c1")
    assert sorted((r.k, r.n) for r in held.collect()) == [(1, 1), (1, 2), (2, 1)]  # the last row's session is still open
    right = read("b").select("k", F.col("ts").alias("ts2"), F.col("value").alias("v2"))
    both = streams.joined(read("a").select("k", "ts", "value"), right, "k", "ts", "ts2", "1 hour", "1 day").select("a.k", F.col("v2"))
    assert sorted((r.k, r.v2) for r in streams.run_once(both, "both", "append", f"{p}/c2").collect()) == [(1, 2.0), (1, 2.0)]


def test_diverse_considers_every_row(spark):
    """Over 1,200 rows of one static score in two groups; the far ones have the largest ids."""
    import numpy as np

    rng = np.random.default_rng(3)
    vecs = rng.normal(size=(1200, 4))
    vecs[:1100, 1:] *= 0.05
    vecs[:1100, 0] = np.abs(vecs[:1100, 0]) + 0.5
    vecs /= np.linalg.norm(vecs, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, i % 2, 0.0, v.tolist()) for i, v in enumerate(vecs)], "segment_id int, channel int, s double, e array<double>")
    for keys in ([], ["channel"]):
        want = []
        for group in ([range(1200)] if not keys else [range(0, 1200, 2), range(1, 1200, 2)]):
            chosen = [group[0]]
            while len(chosen) < 4:
                chosen.append(min((i for i in group if i not in chosen), key=lambda i: ((vecs[chosen] @ vecs[i]).max(), i)))
            want += [(i, at) for at, i in enumerate(chosen, 1)]
        got = rows(Q.diverse(df, "s", "e", "segment_id", 4, keys=keys), "segment_id", "picked")
        assert sorted(got) == sorted(want)
    from loomcast.plans import steps

    chosen = {"strategy": "balanced", "n": 3, "n_unclustered": 6}
    picked = steps.STEPS["select_segments"].run(steps.Context(df, ""), chosen).frames["selected"]
    assert picked.where("segment_id >= 1100").count() > 0


def test_too_many_themes_are_an_error(spark):
    from loomcast.plans import steps

    themed = spark.createDataFrame([(i, i) for i in range(101)], "segment_id int, cluster int")
    with pytest.raises(ValueError, match="at most 100 themes"):
        run, defaults = steps.STEPS["extract_subthemes"].run, steps.STEPS["extract_subthemes"].defaults
        run(steps.Context(themed, "", frames={"themed": themed}), defaults)
