"""WIN, TOP and SET: ranking, runs, top-k and keyed unions bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomcast.functions import predicates as P
from loomcast.functions import scores as S
from loomcast.functions import text as X
from loomcast.functions import vectors as V
from loomcast.operators import sets as Sets
from loomcast.operators import windows as Wn
from loomcast.operators.ranges import capped_groups
from loomcast.operators.windows import top, top_per_group
from loomcast.plans.filters import ORDERS_NOW
from loomcast.plans.registry import Tables, query

TOP3 = """, r AS (SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY publish_date DESC, content_id) AS rn FROM content WHERE publish_date >= TIMESTAMP '2000-01-01'),
s AS (SELECT r.channel_id, r.content_id, round(greatest(coalesce(h.score, 0), 0) * exp(-0.15 * floor((epoch(TIMESTAMP '2001-08-02') - epoch(r.publish_date)) / 86400)), 6) AS rank_score
  FROM r LEFT JOIN channels h USING (channel_id) WHERE rn = 1)
SELECT * FROM s ORDER BY rank_score DESC, content_id LIMIT 20"""


@query("TOP-3", TOP3)
def explore_recent(spark: SparkSession, d: str) -> DataFrame:
    """The latest episode of each channel by importance that decays with age: the first 20."""
    t = Tables(spark, d)
    latest = top_per_group(t.content.where(F.col("publish_date") >= "2000-01-01"), ["channel_id"], [F.col("publish_date").desc_nulls_first(), F.col("content_id")])
    age = S.days_between(F.lit(ORDERS_NOW).cast("timestamp"), F.col("publish_date"))
    score = F.greatest(F.coalesce("score", F.lit(0.0)), F.lit(0.0)) * S.exponential_decay(age)
    scored = latest.join(t.channels.select("channel_id", "score"), "channel_id", "left").select("channel_id", "content_id", F.round(score, 6).alias("rank_score"))
    return top(scored, [F.col("rank_score").desc(), F.col("content_id")], 20)


@query("WIN-2", ", r AS (SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY duration, content_id) AS rn FROM content) SELECT channel_id, content_id, duration FROM r WHERE rn = 1")
def least_rank(spark: SparkSession, d: str) -> DataFrame:
    c = Tables(spark, d).content
    return c.groupBy("channel_id").agg(F.min(F.struct("duration", "content_id")).alias("m")).select("channel_id", "m.content_id", "m.duration")


@query("WIN-3", ", r AS (SELECT *, row_number() OVER (PARTITION BY platform ORDER BY publish_date DESC, content_id) AS rn FROM content WHERE state = 'O') SELECT platform, content_id, rn FROM r WHERE rn <= 10")
def newest_per_platform(spark: SparkSession, d: str) -> DataFrame:
    pending = Tables(spark, d).content.where("state = 'O'")
    order = [F.col("publish_date").desc(), F.col("content_id")]
    kept = top_per_group(pending, ["platform"], order, 10)
    return kept.select("platform", "content_id", F.row_number().over(Window.partitionBy("platform").orderBy(*order)).cast("long").alias("rn"))


@query("WIN-4", "SELECT segment_id, row_number() OVER (PARTITION BY content_id ORDER BY start_time, segment_id) AS seq FROM segments")
def chunk_sequence(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("content_id").orderBy("start_time", "segment_id")
    return Tables(spark, d).segments.select("segment_id", F.row_number().over(w).cast("long").alias("seq"))


@query("WIN-5", """, r AS (SELECT *, row_number() OVER (PARTITION BY event_type, CASE WHEN event_type = 'view' THEN k ELSE user_id END ORDER BY ts, event_id) AS rn FROM ev)
SELECT event_id FROM r WHERE rn = 1""")
def dedup_tasks(spark: SparkSession, d: str) -> DataFrame:
    key = F.when(F.col("event_type") == "view", F.col("k")).otherwise(F.col("user_id"))
    return top_per_group(Tables(spark, d).events, [F.col("event_type"), key], [F.col("ts"), F.col("event_id")]).select("event_id")


@query("WIN-6", ", r AS (SELECT *, row_number() OVER (PARTITION BY content_id ORDER BY length DESC, segment_id) AS rn FROM segments) SELECT content_id, segment_id FROM r WHERE rn <= 3")
def longest_three(spark: SparkSession, d: str) -> DataFrame:
    return top_per_group(Tables(spark, d).segments, ["content_id"], [F.col("length").desc(), F.col("segment_id")], 3).select("content_id", "segment_id")


@query("WIN-7", ", r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY nullif(k, 50) DESC NULLS LAST, event_id) AS rn FROM ev) SELECT user_id, event_id FROM r WHERE rn = 1")
def dedup_nulls_last(spark: SparkSession, d: str) -> DataFrame:
    return top_per_group(Tables(spark, d).events, ["user_id"], [F.nullif(F.col("k"), F.lit(50)).desc_nulls_last(), F.col("event_id")]).select("user_id", "event_id")


@query("WIN-8", ", r AS (SELECT *, row_number() OVER (PARTITION BY content_id ORDER BY confidence DESC, segment_id) AS rn FROM segments) SELECT content_id, segment_id FROM r WHERE rn = 1")
def best_per_episode(spark: SparkSession, d: str) -> DataFrame:
    return top_per_group(Tables(spark, d).segments, ["content_id"], [F.col("confidence").desc(), F.col("segment_id")]).select("content_id", "segment_id")


@query("WIN-9", """, r AS (SELECT *, row_number() OVER (PARTITION BY content_id ORDER BY confidence DESC, segment_id) AS rn FROM segments),
q AS (SELECT c.channel_id, r.segment_id, row_number() OVER (PARTITION BY c.channel_id ORDER BY r.confidence DESC, r.segment_id) AS rk FROM r JOIN content c USING (content_id) WHERE rn = 1)
SELECT channel_id, segment_id FROM q WHERE rk <= 2""")
def most_per_channel(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    best = top_per_group(t.segments.select("content_id", "segment_id", "confidence"), ["content_id"], [F.col("confidence").desc(), F.col("segment_id")])
    return top_per_group(best.join(t.content.select("content_id", "channel_id"), "content_id"), ["channel_id"], [F.col("confidence").desc(), F.col("segment_id")], 2).select("channel_id", "segment_id")


@query("WIN-10", """, r AS (SELECT segment_id, emotion, lag(emotion) OVER w AS p, lead(emotion) OVER w AS n FROM segments WINDOW w AS (PARTITION BY content_id ORDER BY start_time, segment_id))
SELECT segment_id, CASE WHEN p = n AND p <> emotion THEN p ELSE emotion END AS emotion FROM r""")
def interruptions(spark: SparkSession, d: str) -> DataFrame:
    return Wn.absorb_interruptions(Tables(spark, d).segments, ["content_id"], ["start_time", "segment_id"], "emotion").select("segment_id", "emotion")


RUNS = """, f AS (SELECT *, CASE WHEN emotion IS DISTINCT FROM lag(emotion) OVER w OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS new FROM segments WINDOW w AS (PARTITION BY content_id ORDER BY start_time, segment_id)),
g AS (SELECT *, sum(new) OVER (PARTITION BY content_id ORDER BY start_time, segment_id ROWS UNBOUNDED PRECEDING) AS run FROM f)
"""


def turn_runs(t: Tables) -> DataFrame:
    return Wn.runs(t.segments, ["content_id"], ["start_time", "segment_id"], "emotion")


@query("WIN-12", RUNS + "SELECT content_id, run::BIGINT AS run, min(emotion) AS emotion, count(*) AS n, round(sum(length), 2) AS total FROM g GROUP BY 1, 2")
def speaker_runs(spark: SparkSession, d: str) -> DataFrame:
    return turn_runs(Tables(spark, d)).groupBy("content_id", "run").agg(F.min("emotion").alias("emotion"), F.count(F.lit(1)).alias("n"), F.round(F.sum("length"), 2).alias("total"))


@query("WIN-13", RUNS + "SELECT segment_id, run::BIGINT AS run, row_number() OVER (PARTITION BY content_id, run ORDER BY start_time, segment_id) AS in_turn, row_number() OVER (PARTITION BY content_id ORDER BY start_time, segment_id) AS at FROM g")
def sentence_numbers(spark: SparkSession, d: str) -> DataFrame:
    r = turn_runs(Tables(spark, d))
    number = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy("start_time", "segment_id")).cast("long")
    return r.select("segment_id", "run", number("content_id", "run").alias("in_turn"), number("content_id").alias("at"))


@query("WIN-14", RUNS + "SELECT content_id, run::BIGINT AS run, arg_min(start_time, (start_time, segment_id)) AS first_start, arg_max(end_time, (start_time, segment_id)) AS last_end FROM g GROUP BY 1, 2")
def turn_edges(spark: SparkSession, d: str) -> DataFrame:
    at = F.struct("start_time", "segment_id")
    return turn_runs(Tables(spark, d)).groupBy("content_id", "run").agg(F.min_by("start_time", at).alias("first_start"), F.max_by("end_time", at).alias("last_end"))


@query("WIN-15", """, s AS (SELECT conv_id, turn, length(text)::DOUBLE AS x, row_number() OVER w AS a, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
p AS (SELECT conv_id, turn, n, a + d AS k FROM s, range(-3, 4) t(d)), q AS (SELECT conv_id, turn, CASE WHEN (((k - 1) % (2 * n)) + 2 * n) % (2 * n) < n THEN (((k - 1) % (2 * n)) + 2 * n) % (2 * n) + 1 ELSE 2 * n - (((k - 1) % (2 * n)) + 2 * n) % (2 * n) END AS a FROM p)
SELECT q.conv_id, q.turn, round(sum(s.x) / 7, 4) AS smooth FROM q JOIN s ON s.conv_id = q.conv_id AND s.a = q.a GROUP BY 1, 2""")
def smoothed(spark: SparkSession, d: str) -> DataFrame:
    lengths = Tables(spark, d).turns.select("conv_id", "turn", F.length("text").cast("double").alias("x"))
    return Wn.smooth(lengths, ["conv_id"], ["turn"], "x").select("conv_id", "turn", F.round("smooth", 4).alias("smooth"))


@query("WIN-16", "SELECT event_id, round(value - (SELECT avg(value) FROM ev), 4) AS centred FROM ev")
def centred(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events
    return e.crossJoin(F.broadcast(e.agg(F.avg("value").alias("m")))).select("event_id", F.round(F.col("value") - F.col("m"), 4).alias("centred"))


@query("WIN-18", """, s AS (SELECT content_id, segment_id, start_time % 1000 AS a, start_time % 1000 + length AS b FROM segments), n AS (SELECT *, row_number() OVER (PARTITION BY content_id ORDER BY a, b, segment_id) AS i FROM s),
r(content_id, i, grp, a0, b) AS (SELECT content_id, i, 1::BIGINT, a, b FROM n WHERE i = 1 UNION ALL
  SELECT n.content_id, n.i, r.grp + (n.a - r.b >= 300 OR n.b - r.a0 > 400)::INT, CASE WHEN n.a - r.b >= 300 OR n.b - r.a0 > 400 THEN n.a ELSE r.a0 END, n.b FROM r JOIN n ON n.content_id = r.content_id AND n.i = r.i + 1)
SELECT content_id, grp, round(min(a0), 4) AS a, round(arg_max(b, i), 4) AS b, count(*) AS n FROM r GROUP BY 1, 2""")
def gap_merge(spark: SparkSession, d: str) -> DataFrame:
    """Segments under 300 apart are one group, as long as it lasts no more than 400."""
    s = Tables(spark, d).segments.select("content_id", "segment_id", (F.col("start_time") % 1000).alias("a"), (F.col("start_time") % 1000 + F.col("length")).alias("b"))
    grouped = capped_groups(s, "content_id", "a", "b", 300, 400)
    last = F.max_by("b", F.struct("a", "b", "segment_id"))
    return grouped.groupBy("content_id", "grp").agg(F.round(F.min("a"), 4).alias("a"), F.round(last, 4).alias("b"), F.count(F.lit(1)).alias("n"))


@query("WIN-19", "SELECT event_id, floor((row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) / 8)::BIGINT AS batch FROM ev")
def batched(spark: SparkSession, d: str) -> DataFrame:
    return Wn.batches(Tables(spark, d).events, ["user_id"], ["ts", "event_id"], 8).select("event_id", "batch")


@query("WIN-20", r""", l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents), n AS (SELECT *, lead(t) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM l)
SELECT doc_id, i FROM n WHERE nxt IS NOT NULL AND (CASE WHEN trim(t) = '' THEN 0 ELSE len(regexp_split_to_array(trim(t), '[ \t\n\v\f\r]+')) END <= 60 AND NOT regexp_matches(t, '[.!?]\s*$') OR regexp_matches(nxt, '^[a-z]'))""")
def orphan_turns(spark: SparkSession, d: str) -> DataFrame:
    """Lines of a text as turns: short ones without an end of sentence, and those that the next goes on from."""
    lines = Tables(spark, d).documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "t"))
    t = lines.withColumn("nxt", F.lead("t").over(Window.partitionBy("doc_id").orderBy("i")))
    short = (X.word_count(F.col("t")) <= 60) & ~X.ends_sentence(F.col("t"))
    return t.where(F.col("nxt").isNotNull() & (short | F.col("nxt").rlike("^[a-z]"))).select("doc_id", (F.col("i") + 1).cast("long").alias("i"))


@query("WIN-21", """, n AS (SELECT content_id, speaker_id, count(*) AS n FROM segments WHERE emotion <> 'N' GROUP BY 1, 2), t AS (SELECT content_id, sum(n) AS total FROM n GROUP BY 1),
r AS (SELECT n.*, total, row_number() OVER (PARTITION BY content_id ORDER BY n DESC, speaker_id) AS rk FROM n JOIN t USING (content_id))
SELECT s.segment_id, r.speaker_id FROM segments s JOIN r USING (content_id) WHERE s.emotion = 'N' AND rk = 1 AND n >= 0.6 * total""")
def fragment_speaker(spark: SparkSession, d: str) -> DataFrame:
    s = Tables(spark, d).segments
    counts = s.where("emotion <> 'N'").groupBy("content_id", "speaker_id").agg(F.count(F.lit(1)).alias("n"))
    main = counts.groupBy("content_id").agg(F.sum("n").alias("total"), F.min(F.struct((-F.col("n")).alias("m"), "speaker_id")).alias("b"))
    main = main.where(-F.col("b.m") >= 0.6 * F.col("total")).select("content_id", F.col("b.speaker_id").alias("speaker_id"))
    return s.where("emotion = 'N'").select("content_id", "segment_id").join(main, "content_id").select("segment_id", "speaker_id")


@query("TOP-1", """, q AS (SELECT e AS qe FROM vec WHERE vec_id = 0), r AS (SELECT label, vec_id, round(list_cosine_similarity(e, qe), 6) AS sim FROM vec, q),
k AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY sim DESC, vec_id) AS rn FROM r) SELECT label, vec_id, sim FROM k WHERE rn <= 5""")
def nearest_per_label(spark: SparkSession, d: str) -> DataFrame:
    v = Tables(spark, d).vectors
    scored = v.crossJoin(F.broadcast(v.where("vec_id = 0").select(F.col("e").alias("qe")))).select("label", "vec_id", F.round(V.cosine(F.col("e"), F.col("qe"), 0.0), 6).alias("sim"))
    return top_per_group(scored, ["label"], [F.col("sim").desc(), F.col("vec_id")], 5)


@query("TOP-2", "SELECT segment_id, length FROM segments ORDER BY length DESC, segment_id LIMIT 30")
def top_global(spark: SparkSession, d: str) -> DataFrame:
    return top(Tables(spark, d).segments.select("segment_id", "length"), [F.col("length").desc(), F.col("segment_id")], 30)


@query("TOP-4", """SELECT content_id, (floor(epoch(publish_date) / 86400) * 1000 + CASE WHEN platform = '1-URGENT' THEN 1000000 ELSE 0 END + CASE WHEN publish_date >= TIMESTAMP '2001-07-01' THEN 10000000 ELSE 0 END)::BIGINT AS priority
FROM content ORDER BY priority DESC, content_id LIMIT 40""")
def priority_bands(spark: SparkSession, d: str) -> DataFrame:
    score = F.floor(F.unix_timestamp("publish_date") / 86400) * 1000 + F.when(F.col("platform") == "1-URGENT", 1_000_000).otherwise(0) + F.when(F.col("publish_date") >= "2001-07-01", 10_000_000).otherwise(0)
    return top(Tables(spark, d).content.select("content_id", score.alias("priority")), [F.col("priority").desc(), F.col("content_id")], 40)


@query("TOP-5", "SELECT event_id, nullif(k, 99) AS k FROM ev ORDER BY nullif(k, 99) DESC NULLS LAST, event_id LIMIT 25")
def nulls_last(spark: SparkSession, d: str) -> DataFrame:
    return top(Tables(spark, d).events.select("event_id", F.nullif(F.col("k"), F.lit(99)).alias("k")), [F.col("k").desc_nulls_last(), F.col("event_id")], 25)


@query("TOP-6", "SELECT content_id, segment_id FROM segments WHERE status = 'O' ORDER BY confidence DESC, content_id, idx, segment_id LIMIT 1")
def claim_order(spark: SparkSession, d: str) -> DataFrame:
    order = [F.col("confidence").desc(), F.col("content_id"), F.col("idx"), F.col("segment_id")]
    return top(Tables(spark, d).segments.where("status = 'O'"), order, 1).select("content_id", "segment_id")


@query("TOP-7", ", n AS (SELECT event_id, event_type FROM ev ORDER BY k DESC NULLS LAST, ts, event_id LIMIT 100) SELECT event_id FROM n WHERE event_type <> 'error'")
def next_tasks(spark: SparkSession, d: str) -> DataFrame:
    """Blocked types are removed after the limit, so that fewer than it may come back."""
    return top(Tables(spark, d).events, [F.col("k").desc_nulls_last(), F.col("ts"), F.col("event_id")], 100).where("event_type <> 'error'").select("event_id")


@query("TOP-8", "SELECT doc_id FROM documents ORDER BY md5(doc_id::VARCHAR), doc_id LIMIT 20")
def random_sample(spark: SparkSession, d: str) -> DataFrame:
    """A sample that is the same each time: the first rows by a hash of their id."""
    return top(Tables(spark, d).documents.select("doc_id"), [F.md5(F.col("doc_id").cast("string")), F.col("doc_id")], 20)


@query("TOP-9", ", r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id::VARCHAR), doc_id) AS rn FROM documents) SELECT doc_id, lang FROM r WHERE rn <= 5")
def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    return top_per_group(Tables(spark, d).documents.select("doc_id", "lang"), ["lang"], [F.md5(F.col("doc_id").cast("string")), F.col("doc_id")], 5)


@query("TOP-10", """, a AS (SELECT *, row_number() OVER (PARTITION BY emotion ORDER BY segment_id) AS rn FROM segments), u AS (SELECT segment_id FROM a WHERE rn <= 5),
b AS (SELECT s.emotion, s.status, s.segment_id, row_number() OVER (PARTITION BY s.emotion, s.status ORDER BY u.segment_id IS NOT NULL, s.segment_id) AS rn FROM segments s LEFT JOIN u USING (segment_id))
SELECT emotion, status, segment_id FROM b WHERE rn <= 3""")
def unused_first(spark: SparkSession, d: str) -> DataFrame:
    s = Tables(spark, d).segments.select("emotion", "status", "segment_id")
    used = top_per_group(s, ["emotion"], [F.col("segment_id")], 5).select("segment_id", F.lit(True).alias("used"))
    return top_per_group(s.join(used, "segment_id", "left"), ["emotion", "status"], [F.coalesce("used", F.lit(False)), F.col("segment_id")], 3).select("emotion", "status", "segment_id")


MEAN = """, c AS (SELECT label, i, avg(e[i]) AS m FROM vec, range(1, 65) r(i) GROUP BY 1, 2), cm AS (SELECT label, list(m ORDER BY i) AS m FROM c GROUP BY 1)
"""


@query("TOP-11", MEAN + ", r AS (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY round(list_cosine_similarity(e, m), 9) DESC, vec_id) AS rn FROM vec JOIN cm USING (label)) SELECT label, vec_id FROM r WHERE rn <= 3")
def representatives(spark: SparkSession, d: str) -> DataFrame:
    v = Tables(spark, d).vectors
    near = v.join(V.mean_vectors(v, ["label"]).withColumnRenamed("e", "m"), "label").withColumn("c", F.round(V.cosine(F.col("e"), F.col("m"), 0.0), 9))
    return top_per_group(near, ["label"], [F.col("c").desc(), F.col("vec_id")], 3).select("label", "vec_id")


@query("TOP-12", ", q AS (SELECT e AS qe FROM vec WHERE vec_id = 1) SELECT vec_id, round(list_distance(e, qe), 6) AS dist FROM vec, q ORDER BY round(list_distance(e, qe), 9), vec_id LIMIT 10")
def closest(spark: SparkSession, d: str) -> DataFrame:
    v = Tables(spark, d).vectors
    far = v.crossJoin(F.broadcast(v.where("vec_id = 1").select(F.col("e").alias("qe")))).select("vec_id", V.euclidean(F.col("e"), F.col("qe")).alias("x"))
    return top(far, [F.round("x", 9), F.col("vec_id")], 10).select("vec_id", F.round("x", 6).alias("dist"))


@query("TOP-13", "SELECT speaker_id, round(sum(length) / 3600, 4) AS hours FROM segments GROUP BY 1 HAVING sum(length) / 3600 > 2 ORDER BY sum(length) DESC, speaker_id LIMIT 50")
def layout_input(spark: SparkSession, d: str) -> DataFrame:
    sums = Tables(spark, d).segments.groupBy("speaker_id").agg(F.sum("length").alias("x")).where("x / 3600 > 2")
    return top(sums, [F.col("x").desc(), F.col("speaker_id")], 50).select("speaker_id", F.round(F.col("x") / 3600, 4).alias("hours"))


@query("SET-1", "SELECT 'content' AS name, count(*) AS n FROM content UNION ALL SELECT 'segments', count(*) FROM segments UNION ALL SELECT 'channels', count(*) FROM channels")
def row_counts(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    counts = [f.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, f in (("content", t.content), ("segments", t.segments), ("channels", t.channels))]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


SIMS = """, q AS (SELECT vec_id AS qi, e AS qe FROM vec WHERE vec_id IN (0, 1, 2)), r AS (SELECT vec_id, qi, round(list_cosine_similarity(e, qe), 6) AS sim FROM vec, q)
"""


def similarities(t: Tables, query_id: int) -> DataFrame:
    v = t.vectors
    asked = F.broadcast(v.where(F.col("vec_id") == query_id).select(F.col("e").alias("qe")))  # one row
    return v.crossJoin(asked).select("vec_id", F.round(V.cosine(F.col("e"), F.col("qe"), 0.0), 6).alias("sim"))


@query("SET-2", SIMS + "SELECT vec_id, max(sim) AS sim FROM r WHERE sim > 0.1 GROUP BY 1")
def keep_max(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return Sets.union_keep_best([similarities(t, i).where("sim > 0.1") for i in (0, 1, 2)], "vec_id", "sim")


@query("SET-3", SIMS + ", k AS (SELECT vec_id, sim, row_number() OVER (PARTITION BY vec_id ORDER BY qi) AS rn FROM r WHERE sim > 0.1) SELECT vec_id, sim FROM k WHERE rn = 1")
def keep_first(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return Sets.union_keep_first([similarities(t, i).where("sim > 0.1") for i in (0, 1, 2)], ["vec_id"], [F.col("sim").desc()])


@query("SET-4", """SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN b.doc_id IS NULL THEN 'semantic' WHEN a.doc_id IS NULL THEN 'keyword' ELSE 'both' END AS matched_via
FROM (SELECT doc_id FROM documents WHERE lang = 'en') a FULL JOIN (SELECT doc_id FROM documents WHERE text ILIKE '%st%') b ON a.doc_id = b.doc_id""")
def keyword_or_semantic(spark: SparkSession, d: str) -> DataFrame:
    docs = Tables(spark, d).documents
    return Sets.matched_via(docs.where("lang = 'en'"), docs.where(P.must_contain("text", ["st"])), "doc_id", "semantic", "keyword")


@query("SET-5", SIMS + """SELECT coalesce(a.vec_id, b.vec_id) AS vec_id, CASE WHEN b.sim IS NULL OR a.sim > b.sim THEN 'en' WHEN a.sim IS NULL OR b.sim > a.sim THEN 'fr' ELSE 'both' END AS via
FROM (SELECT * FROM r WHERE qi = 0 AND sim > 0.1) a FULL JOIN (SELECT * FROM r WHERE qi = 1 AND sim > 0.1) b ON a.vec_id = b.vec_id""")
def two_languages(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    a, b = similarities(t, 0).where("sim > 0.1").toDF("vec_id", "x"), similarities(t, 1).where("sim > 0.1").toDF("vec_id", "y")
    via = F.when(F.col("y").isNull() | (F.col("x") > F.col("y")), "en").when(F.col("x").isNull() | (F.col("y") > F.col("x")), "fr").otherwise("both")
    return a.join(b, "vec_id", "full").select("vec_id", via.alias("via"))


ARR = """, a AS (SELECT content_id, list(DISTINCT emotion) AS x FROM segments WHERE status = 'O' GROUP BY 1), b AS (SELECT content_id, list(DISTINCT emotion) AS y FROM segments WHERE status = 'F' GROUP BY 1)
"""


@query("SET-6", ARR + "SELECT content_id, array_to_string(list_sort(list_distinct(list_concat(coalesce(x, []), coalesce(y, [])))), ',') AS merged FROM a FULL JOIN b USING (content_id)")
def merged_arrays(spark: SparkSession, d: str) -> DataFrame:
    s = Tables(spark, d).segments
    a = s.where("status = 'O'").groupBy("content_id").agg(F.collect_set("emotion").alias("x"))
    b = s.where("status = 'F'").groupBy("content_id").agg(F.collect_set("emotion").alias("y"))
    return a.join(b, "content_id", "full").select("content_id", F.array_join(Sets.merge_arrays(F.col("x"), F.col("y")), ",").alias("merged"))


@query("SET-7", """, a AS (SELECT content_id, emotion, max(length) AS v FROM segments WHERE status = 'O' GROUP BY 1, 2), b AS (SELECT content_id, emotion, max(length) AS v FROM segments WHERE status = 'F' GROUP BY 1, 2)
SELECT coalesce(a.content_id, b.content_id) AS content_id, coalesce(a.emotion, b.emotion) AS emotion, coalesce(a.v, b.v) AS v FROM a FULL JOIN b ON a.content_id = b.content_id AND a.emotion = b.emotion""")
def merged_maps(spark: SparkSession, d: str) -> DataFrame:
    s = Tables(spark, d).segments.groupBy("content_id", "status", "emotion").agg(F.max("length").alias("v"))
    maps = s.groupBy("content_id").agg(*[F.map_from_entries(F.collect_list(F.when(F.col("status") == x, F.struct("emotion", "v")))).alias(x) for x in ("O", "F")])
    return maps.select("content_id", F.explode(Sets.merge_maps(F.col("O"), F.col("F"))).alias("emotion", "v"))


@query("WIN-11", """, w AS (SELECT user_id, event_id, ts, CASE WHEN k % 3 = 0 THEN '''s' ELSE event_type END AS word FROM ev), h AS (SELECT *, sum(CASE WHEN word LIKE '''%' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS hd FROM w),
i AS (SELECT *, row_number() OVER (PARTITION BY user_id, hd ORDER BY ts, event_id) - 1 AS p FROM h), j AS (SELECT user_id, hd, p // 2 AS pr, string_agg(word, '' ORDER BY ts, event_id) AS word FROM i GROUP BY 1, 2, 3)
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY hd, pr) AS at, word FROM j""")
def contractions(spark: SparkSession, d: str) -> DataFrame:
    words = Tables(spark, d).events.select("user_id", "ts", "event_id", F.when(F.col("k") % 3 == 0, "'s").otherwise(F.col("event_type")).alias("word"))
    return Wn.merge_contractions(words, ["user_id"], ["ts", "event_id"], "word")


@query("WIN-17", """SELECT user_id, event_id, rank() OVER w AS rk, dense_rank() OVER w AS dr, ntile(4) OVER (PARTITION BY user_id ORDER BY k, event_id) AS nt,
lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before, lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS after FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY k)""")
def window_functions(spark: SparkSession, d: str) -> DataFrame:
    by_k, by_time = Window.partitionBy("user_id").orderBy("k"), Window.partitionBy("user_id").orderBy("ts", "event_id")
    tiles = F.ntile(4).over(Window.partitionBy("user_id").orderBy("k", "event_id"))
    return Tables(spark, d).events.select("user_id", "event_id", F.rank().over(by_k).alias("rk"), F.dense_rank().over(by_k).alias("dr"), tiles.alias("nt"), F.lag("event_id").over(by_time).alias("before"), F.lead("event_id").over(by_time).alias("after"))


@query("SET-8", """, a AS (SELECT DISTINCT user_id FROM ev WHERE event_type = 'purchase'), b AS (SELECT DISTINCT user_id FROM ev WHERE event_type = 'error' AND k < 20)
SELECT 'both' AS part, user_id FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'first only', user_id FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'any', user_id FROM (SELECT * FROM a UNION SELECT * FROM b)""")
def set_algebra(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events
    a, b = e.where("event_type = 'purchase'").select("user_id"), e.where("event_type = 'error' AND k < 20").select("user_id")
    parts = {"both": a.intersect(b), "first only": a.subtract(b), "any": a.union(b).distinct()}
    tagged = [f.select(F.lit(name).alias("part"), "user_id") for name, f in parts.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])
