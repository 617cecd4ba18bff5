"""JON: joins bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomcast.functions.vectors import cosine
from loomcast.operators import aggregates as A
from loomcast.operators import joins as J
from loomcast.operators.cluster import BLOCK_ROWS
from loomcast.operators.fuzzy import best_matches, plain_title
from loomcast.operators.search import some_pair, tiled
from loomcast.operators.windows import top_per_group
from loomcast.plans.registry import Tables, query

#: Spans per episode: one interval of 60 for every segment of the returned kind, per content.
SPANS_SQL = """, w AS (SELECT content_id, segment_id, start_time % 1000 AS ws, start_time % 1000 + length AS we FROM segments WHERE emotion = 'N'),
sp AS (SELECT content_id, speaker_id, segment_id AS span_id, start_time % 1000 AS ss, start_time % 1000 + 3 * length AS se FROM segments WHERE emotion <> 'N')
"""


def words(t: Tables) -> DataFrame:
    return t.segments.where("emotion = 'N'").select("content_id", "segment_id", (F.col("start_time") % 1000).alias("ws"), (F.col("start_time") % 1000 + F.col("length")).alias("we"))


def spans(t: Tables) -> DataFrame:
    return t.segments.where("emotion <> 'N'").select("content_id", "speaker_id", F.col("segment_id").alias("span_id"), (F.col("start_time") % 1000).alias("ss"), (F.col("start_time") % 1000 + 3 * F.col("length")).alias("se"))


@query("JON-1", "SELECT c.platform, count(*) AS n, round(sum(s.length), 2) AS total FROM segments s JOIN content c USING (content_id) GROUP BY 1")
def inner(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return t.segments.join(t.content, "content_id").groupBy("platform").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("length"), 2).alias("total"))


@query("JON-2", "SELECT h.project, s.emotion, count(*) AS n FROM segments s JOIN content c USING (content_id) JOIN channels h USING (channel_id) WHERE c.publish_date BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31' GROUP BY 1, 2")
def three_way(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    kept = t.content.where(F.col("publish_date").between("1996-01-01", "1998-12-31")).join(t.channels.select("channel_id", "project"), "channel_id")
    return t.segments.join(kept, "content_id").groupBy("project", "emotion").agg(F.count(F.lit(1)).alias("n"))


@query("JON-3", "SELECT h.channel_id, count(c.content_id) AS n FROM channels h LEFT JOIN content c USING (channel_id) GROUP BY 1")
def left_outer(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    counts = t.content.groupBy("channel_id").agg(F.count(F.lit(1)).alias("n"))  # aggregated before the join
    return t.channels.select("channel_id").join(counts, "channel_id", "left").select("channel_id", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


@query("JON-4", """, s AS (SELECT ts::DATE AS day, count(*) AS n_source FROM ev GROUP BY 1), c AS (SELECT ts::DATE AS day, count(*) AS n_cache FROM ev WHERE k % 10 <> 3 OR event_type = 'view' GROUP BY 1)
SELECT strftime(s.day, '%Y-%m-%d') AS day, n_source, coalesce(n_cache, 0) AS n_cache FROM s LEFT JOIN c USING (day) WHERE coalesce(n_cache, 0) < n_source * 0.93""")
def gap_join(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events
    return A.gap_days(e, e.where("k % 10 <> 3 OR event_type = 'view'"), "ts", "ts", 0.93).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("JON-5", """SELECT p.s_suppkey AS speaker_id, count(DISTINCT s.content_id) AS episodes, count(DISTINCT c.channel_id) AS n_channels
FROM supplier p LEFT JOIN segments s ON s.speaker_id = p.s_suppkey LEFT JOIN content c USING (content_id) GROUP BY 1 HAVING count(DISTINCT s.content_id) >= 100""")
def multi_left_having(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    said = t.segments.select("speaker_id", "content_id").distinct().join(t.content.select("content_id", "channel_id"), "content_id", "left")
    out = t.raw("supplier").select(F.col("s_suppkey").alias("speaker_id")).join(said, "speaker_id", "left").groupBy("speaker_id")
    return out.agg(F.count_distinct("content_id").alias("episodes"), F.count_distinct("channel_id").alias("n_channels")).where("episodes >= 100")


@query("JON-6", "SELECT content_id FROM content WHERE content_id IN (SELECT content_id FROM segments WHERE speaker_id = 5)")
def semi_in(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return J.semi(t.content, t.segments.where("speaker_id = 5"), "content_id").select("content_id")


@query("JON-7", "SELECT content_id FROM content c WHERE EXISTS (SELECT 1 FROM segments s WHERE s.content_id = c.content_id AND s.emotion = 'R' AND s.length > 40)")
def semi_exists(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return J.semi(t.content, t.segments.where("emotion = 'R' AND length > 40"), "content_id").select("content_id")


@query("JON-8", "SELECT channel_id FROM channels h WHERE NOT EXISTS (SELECT 1 FROM content c WHERE c.channel_id = h.channel_id AND c.state = 'O')")
def anti_exists(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return J.anti(t.channels, t.content.where("state = 'O'"), "channel_id").select("channel_id")


@query("JON-9", "SELECT content_id FROM content c WHERE NOT EXISTS (SELECT 1 FROM ev WHERE ev.event_id = c.content_id OR (c.platform = '1-URGENT' AND ev.event_id = c.content_id - 10000))")
def anti_or(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    other = F.when(F.col("platform") == "1-URGENT", F.col("content_id") - 10000)
    return J.anti_any_key(t.content, t.events, "content_id", [F.col("content_id"), other], "event_id").select("content_id")


@query("JON-10", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT k FROM ev WHERE k IS NOT NULL)")
def anti_json(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return J.anti(t.documents.select("doc_id"), t.events.select(F.col("k").alias("doc_id")), "doc_id")


@query("JON-11", "SELECT h.channel_id FROM channels h LEFT JOIN content c ON c.channel_id = h.channel_id AND c.state = 'P' WHERE c.content_id IS NULL")
def anti_left_null(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return J.anti(t.channels, t.content.where("state = 'P'"), "channel_id").select("channel_id")


CO = """, m AS (SELECT DISTINCT content_id, speaker_id FROM segments)
"""


@query("JON-12", CO + "SELECT x.speaker_id AS a, y.speaker_id AS b, count(*) AS together FROM m x JOIN m y USING (content_id) WHERE x.speaker_id < y.speaker_id GROUP BY 1, 2")
def co_appearance(spark: SparkSession, d: str) -> DataFrame:
    return J.co_appearance(Tables(spark, d).segments, "content_id", "speaker_id")


@query("JON-13", "SELECT a.channel_id, b.s_suppkey FROM channels a JOIN supplier b ON substr(a.channel_name, 10) = substr(b.s_name, 10)")
def derived_key(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    a = t.channels.select("channel_id", F.substring("channel_name", 10, 100).alias("key"))
    return a.join(t.raw("supplier").select("s_suppkey", F.substring("s_name", 10, 100).alias("key")), "key").select("channel_id", "s_suppkey")


@query("JON-14", """, arr AS (SELECT content_id, list(segment_id ORDER BY length DESC, segment_id) AS ids FROM segments GROUP BY 1),
x AS (SELECT content_id, unnest(ids) AS segment_id, generate_subscripts(ids, 1) AS pos FROM arr)
SELECT x.content_id, string_agg(s.emotion, '' ORDER BY x.pos) AS said FROM x JOIN segments s ON s.segment_id = x.segment_id GROUP BY 1""")
def array_members(spark: SparkSession, d: str) -> DataFrame:
    s = Tables(spark, d).segments
    ids = s.groupBy("content_id").agg(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("length")).alias("l"), "segment_id"))), lambda x: x["segment_id"]).alias("ids"))
    out = J.explode_lookup(ids, "ids", s, "segment_id", "content_id", "emotion", "said")
    return out.select("content_id", F.array_join("said", "").alias("said"))


@query("JON-15", "SELECT s.content_id, bool_or(p.s_acctbal > 5000) AS known FROM segments s LEFT JOIN supplier p ON p.s_suppkey = s.speaker_id GROUP BY 1")
def array_identity(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    held = t.segments.groupBy("content_id").agg(F.collect_set("speaker_id").alias("ids")).select("content_id", F.explode("ids").alias("s_suppkey"))
    return held.join(t.raw("supplier").select("s_suppkey", (F.col("s_acctbal") > 5000).alias("k")), "s_suppkey", "left").groupBy("content_id").agg(F.bool_or("k").alias("known"))


PJ = """, pj AS (SELECT c.content_id, c.publish_date, unnest(list_sort(list_distinct(list(h.project)))) AS project FROM content c JOIN channels h ON h.channel_id IN (c.channel_id, c.channel_id + 1) GROUP BY 1, 2)
"""


@query("JON-16", PJ + "SELECT DISTINCT content_id FROM pj WHERE project IN ('BUILDING', 'FURNITURE')")
def theta_or(spark: SparkSession, d: str) -> DataFrame:
    from loomcast.plans.filters import with_projects

    asked = spark.sql("SELECT * FROM VALUES ('BUILDING'), ('FURNITURE') AS v(project)")
    return with_projects(Tables(spark, d)).select("content_id", F.explode("projects").alias("project")).join(F.broadcast(asked), "project", "left_semi").select("content_id").distinct()


@query("JON-17", PJ + "SELECT year(publish_date) AS y, project, count(*) AS n FROM pj GROUP BY 1, 2")
def unnest(spark: SparkSession, d: str) -> DataFrame:
    from loomcast.plans.filters import with_projects

    rows = with_projects(Tables(spark, d)).select(F.year("publish_date").cast("long").alias("y"), F.explode("projects").alias("project"))
    return rows.groupBy("y", "project").agg(F.count(F.lit(1)).alias("n"))


@query("JON-18", "SELECT emotion AS name, count(*) AS n, count(DISTINCT content_id) AS episodes FROM segments GROUP BY 1")
def json_elements(spark: SparkSession, d: str) -> DataFrame:
    hosts = Tables(spark, d).segments.groupBy("content_id").agg(F.to_json(F.collect_list(F.struct(F.col("emotion").alias("name"), "confidence"))).alias("hosts"))
    rows = hosts.select("content_id", F.explode(F.from_json("hosts", "array<struct<name:string,confidence:double>>")).alias("h"))
    return rows.groupBy("h.name").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("content_id").alias("episodes"))


@query("JON-19", "SELECT content_id, emotion AS name, count(*) AS n FROM segments GROUP BY 1, 2")
def each_entry(spark: SparkSession, d: str) -> DataFrame:
    counts = Tables(spark, d).segments.groupBy("content_id", "emotion").agg(F.count(F.lit(1)).alias("n"))
    maps = counts.groupBy("content_id").agg(F.map_from_entries(F.collect_list(F.struct("emotion", "n"))).alias("m"))
    return maps.select("content_id", F.explode("m").alias("name", "n"))


@query("JON-20", "SELECT event_id, k FROM ev WHERE event_type = 'purchase'")
def recordset(spark: SparkSession, d: str) -> DataFrame:
    batch = Tables(spark, d).events.where("event_type = 'purchase'").groupBy("user_id").agg(F.to_json(F.collect_list(F.struct("event_id", "k"))).alias("rows"))
    return batch.select(F.inline(F.from_json("rows", "array<struct<event_id:bigint,k:bigint>>")))


@query("JON-21", "SELECT event_id FROM ev, (SELECT max(ts) AS latest FROM ev) m WHERE ts >= latest - INTERVAL 6 HOURS")
def cross_scalar(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events
    return e.crossJoin(F.broadcast(e.agg(F.max("ts").alias("latest")))).where(F.col("ts") >= F.col("latest") - F.expr("INTERVAL 6 HOURS")).select("event_id")


BEST = SPANS_SQL + """, o AS (SELECT w.segment_id, sp.speaker_id, sum(least(we, se) - greatest(ws, ss)) AS overlap FROM w JOIN sp ON w.content_id = sp.content_id AND least(we, se) > greatest(ws, ss) GROUP BY 1, 2),
b AS (SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY overlap DESC, speaker_id) AS r FROM o)
"""


@query("JON-22", BEST + "SELECT segment_id, speaker_id, round(overlap, 4) AS overlap FROM b WHERE r = 1")
def overlap_matrix(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return J.best_overlap(words(t), spans(t), "content_id", "segment_id", ("ws", "we"), ("ss", "se"), "speaker_id").withColumn("overlap", F.round("overlap", 4))


@query("JON-23", BEST + "SELECT w.segment_id, we > ws AND max(overlap) / (we - ws) < 0.9 AS multi FROM w JOIN o USING (segment_id) GROUP BY 1, we, ws")
def overlap_ratio(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    w = words(t)
    best = J.best_overlap(w, spans(t), "content_id", "segment_id", ("ws", "we"), ("ss", "se"), "speaker_id")
    length = F.col("we") - F.col("ws")
    return w.join(best, "segment_id").select("segment_id", F.when(length > 0, F.col("overlap") / length < 0.9).otherwise(F.lit(False)).alias("multi"))


@query("JON-24", BEST + """, rest AS (SELECT w.*, (ws + we) / 2 AS mid FROM w WHERE segment_id NOT IN (SELECT segment_id FROM o)),
nr AS (SELECT rest.segment_id, min(least(abs(mid - ss), abs(mid - se))) AS dist FROM rest JOIN sp USING (content_id) GROUP BY 1)
SELECT segment_id, 0.8 AS confidence FROM b WHERE r = 1 UNION ALL SELECT segment_id, round(greatest(0.3, 0.8 - dist / 10), 4) FROM nr""")
def overlap_or_nearest(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    out = J.overlap_else_nearest(words(t), spans(t), "content_id", "segment_id", ("ws", "we"), ("ss", "se"), "speaker_id")
    return out.select("segment_id", F.round("confidence", 4).alias("confidence"))


@query("JON-25", SPANS_SQL + "SELECT w.segment_id, sp.span_id FROM w JOIN sp ON w.content_id = sp.content_id AND sp.ss <= w.we + 20 AND sp.se >= w.ws - 20")
def context(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return J.context_window(words(t), spans(t), "content_id", ("ws", "we"), ("ss", "se"), 20).select("segment_id", "span_id")


DAYS = """SELECT a.content_id, b.content_id AS other FROM content a JOIN content b ON a.platform = '1-URGENT' AND b.platform = '2-HIGH'
AND abs(epoch(a.publish_date) - epoch(b.publish_date)) <= 86400 AND abs(a.duration - b.duration) <= 300"""


@query("JON-26", DAYS)
def date_window(spark: SparkSession, d: str) -> DataFrame:
    c = Tables(spark, d).content
    b = c.where("platform = '2-HIGH'").select(F.col("content_id").alias("other"), F.col("publish_date").alias("other_date"), F.col("duration").alias("other_duration"))
    near = F.abs(F.col("duration") - F.col("other_duration")) <= 300
    return J.day_window(c.where("platform = '1-URGENT'"), b, "publish_date", "other_date", 1, near).select("content_id", "other")


@query("JON-28", """, t AS (SELECT vec_id, label, e, vec_id % 30 AS day FROM vec), r AS (
  SELECT a.vec_id, b.vec_id AS other, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_cosine_similarity(a.e, b.e), 9) DESC, b.vec_id) AS rk
  FROM t a JOIN t b ON a.vec_id <> b.vec_id AND a.label = b.label AND abs(a.day - b.day) <= 2 WHERE a.vec_id % 20 = 0)
SELECT vec_id, other, round(1 - 0.03 * rk, 4)::DOUBLE AS similarity FROM r WHERE rk <= 5""")
def related(spark: SparkSession, d: str) -> DataFrame:
    """The vectors of the stated query set against those of their label within two days."""
    v = Tables(spark, d).vectors.withColumn("day", F.col("vec_id") % 30)
    asked = v.where("vec_id % 20 = 0").withColumn("at", F.explode(F.sequence(F.col("day") - 2, F.col("day") + 2)))
    others = v.select(F.col("vec_id").alias("other"), F.col("e").alias("f"), "label", F.col("day").alias("at"))
    scored = asked.join(others, ["label", "at"]).where("vec_id <> other").withColumn("c", F.round(cosine(F.col("e"), F.col("f"), 0.0), 9)).select("vec_id", "other", "c")
    ranked = scored.withColumn("rk", F.row_number().over(Window.partitionBy("vec_id").orderBy(F.col("c").desc(), "other")))
    return ranked.where("rk <= 5").select("vec_id", "other", F.round(1 - 0.03 * F.col("rk"), 4).alias("similarity"))


@query("JON-29", "SELECT c.content_id, n.n_name FROM content c JOIN channels h USING (channel_id) JOIN nation n ON n.n_nationkey = h.nation WHERE c.state = 'P'")
def lookup(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    nations = t.raw("nation").select(F.col("n_nationkey").alias("nation"), "n_name")  # 25 rows by definition; the optimiser broadcasts it by its size
    return t.content.where("state = 'P'").join(t.channels.select("channel_id", "nation"), "channel_id").join(nations, "nation").select("content_id", "n_name")


@query("JON-30", CO + "SELECT y.speaker_id, count(DISTINCT y.content_id) AS episodes FROM m x JOIN m y USING (content_id) WHERE x.speaker_id = 7 AND y.speaker_id <> 7 GROUP BY 1")
def co_speakers(spark: SparkSession, d: str) -> DataFrame:
    s = Tables(spark, d).segments.select("content_id", "speaker_id").distinct()
    return J.semi(s, s.where("speaker_id = 7"), "content_id").where("speaker_id <> 7").groupBy("speaker_id").agg(F.count(F.lit(1)).alias("episodes"))


@query("JON-31", "SELECT c.content_id, coalesce((SELECT max(length) FROM segments s WHERE s.content_id = c.content_id AND s.idx = 2), 300) AS chunk FROM content c")
def scalar_subquery(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    second = t.segments.where("idx = 2").groupBy("content_id").agg(F.max("length").alias("l"))
    return t.content.join(second, "content_id", "left").select("content_id", F.coalesce("l", F.lit(300.0)).alias("chunk"))


@query("JON-32", "SELECT DISTINCT least(a.label, b.label) AS x, greatest(a.label, b.label) AS y FROM vec a JOIN vec b ON a.label <> b.label AND round(list_cosine_similarity(a.e, b.e), 6) > 0.3")
def conflict_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of labels with rows over 0.3 of each other, of all rows against all, in tiles; each two parts meet once."""
    v = Tables(spark, d).vectors.where("label is not null")
    asked = v.select(F.col("vec_id").alias("query_id"), F.col("e").alias("qe"), F.col("label").alias("l"))
    pairs = tiled(v, asked, some_pair(0.3, "l", "label", differ=True), "vec_id", "e", "query_id", "qe", most=BLOCK_ROWS, once=True)
    return pairs.select(F.least("l", "label").alias("x"), F.greatest("l", "label").alias("y")).distinct()


COVER = SPANS_SQL + """, s AS (SELECT w.segment_id, sum(greatest(0, least(we, se) - greatest(ws, ss))) AS c FROM w JOIN sp USING (content_id) GROUP BY 1)
"""


@query("JON-33", COVER + "SELECT w.segment_id, round(coalesce(c, 0), 4) AS covered FROM w LEFT JOIN s USING (segment_id) WHERE CASE WHEN we > ws THEN coalesce(c, 0) / (we - ws) ELSE 0 END < 0.5")
def coverage(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return J.coverage(words(t), spans(t), "content_id", "segment_id", ("ws", "we"), ("ss", "se")).where("ratio < 0.5").select("segment_id", F.round("covered", 4).alias("covered"))


@query("JON-34", SPANS_SQL + """, cs AS (SELECT *, coalesce(sum(se - ss) OVER (PARTITION BY content_id ORDER BY ss, span_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cs FROM sp),
x AS (SELECT content_id, segment_id, we - ws AS l, ws AS t FROM w), m AS (SELECT x.content_id, segment_id, l, coalesce(arg_max(ss + t - cs, cs), any_value(t)) AS s FROM x LEFT JOIN cs ON cs.content_id = x.content_id AND t BETWEEN cs AND cs + se - ss GROUP BY 1, 2, 3),
c AS (SELECT m.segment_id, sum(greatest(0, least(s + l, se) - greatest(s, ss))) AS c FROM m JOIN sp USING (content_id) GROUP BY 1)
SELECT m.segment_id, round(coalesce(c, 0), 4) AS covered, coalesce(c, 0) / l < 0.5 AS low FROM m LEFT JOIN c USING (segment_id)""")
def coverage_concatenated(spark: SparkSession, d: str) -> DataFrame:
    """Words timed on an episode's spans laid end to end: moved back to the episode's own times, then held against the spans."""
    t = Tables(spark, d)
    back = J.concatenated(spans(t), "content_id", "ss", "se", "span_id")
    placed = J.remap_times(words(t).withColumn("l", F.col("we") - F.col("ws")), back, "content_id", "ws", "s").withColumn("e", F.col("s") + F.col("l"))
    out = J.coverage(placed.select("content_id", "segment_id", "s", "e"), spans(t), "content_id", "segment_id", ("s", "e"), ("ss", "se"))
    return out.select("segment_id", F.round("covered", 4).alias("covered"), (F.col("ratio") < 0.5).alias("low"))


@query("JON-35", SPANS_SQL + """, x AS (SELECT w.segment_id, min(ss) AS s, max(se) AS e FROM w JOIN sp ON w.content_id = sp.content_id AND least(we, se) > greatest(ws, ss) GROUP BY 1)
SELECT w.segment_id, round(greatest(least(coalesce(s, ws), ws), ws - 30), 4) AS new_start, round(least(greatest(coalesce(e, we), we), we + 30), 4) AS new_end FROM w LEFT JOIN x USING (segment_id)""")
def expanded(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    out = J.expand_by(words(t), spans(t), "content_id", "segment_id", ("ws", "we"), ("ss", "se"), 30)
    return out.select("segment_id", F.round("new_start", 4).alias("new_start"), F.round("new_end", 4).alias("new_end"))


@query("JON-36", SPANS_SQL + """, mp AS (SELECT content_id, ss AS fs, se AS fe, ss / 2 AS tst, span_id AS o FROM sp),
h AS (SELECT w.segment_id, w.ws, arg_max(tst + ws - fs, o) AS m FROM w JOIN mp ON w.content_id = mp.content_id AND ws BETWEEN fs AND fe GROUP BY 1, 2)
SELECT w.segment_id, round(coalesce(m, ws), 4) AS mapped FROM w LEFT JOIN h USING (segment_id, ws)""")
def remapped(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    mapping = spans(t).select("content_id", F.col("ss").alias("from_start"), F.col("se").alias("from_end"), (F.col("ss") / 2).alias("to_start"), F.col("span_id").alias("ordinal"))
    return J.remap_times(words(t), mapping, "content_id", "ws").select("segment_id", F.round("mapped", 4).alias("mapped"))


@query("JON-37", """, a AS (SELECT DISTINCT speaker_id AS x, content_id % 50 AS m FROM segments), b AS (SELECT DISTINCT channel_id % 10 AS y, content_id % 50 AS m FROM content),
na AS (SELECT x, count(*) AS n FROM a GROUP BY 1), nb AS (SELECT y, count(*) AS n FROM b GROUP BY 1),
j AS (SELECT x, y, count(*) AS shared FROM a JOIN b USING (m) GROUP BY 1, 2),
r AS (SELECT j.x, j.y, shared, shared / na.n AS o, shared / nb.n AS c FROM j JOIN na USING (x) JOIN nb USING (y)),
k AS (SELECT *, row_number() OVER (PARTITION BY x ORDER BY o DESC, y) AS rk FROM r)
SELECT x, y, shared, CASE WHEN o >= 0.9 AND c >= 0.4 THEN 'auto' WHEN o >= 0.7 THEN 'review' ELSE 'none' END AS band FROM k WHERE rk = 1""")
def set_match(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    a = t.segments.select(F.col("speaker_id").alias("x"), (F.col("content_id") % 50).alias("m"))
    b = t.content.select((F.col("channel_id") % 10).alias("y"), (F.col("content_id") % 50).alias("m"))
    best = top_per_group(J.set_match(a, b, "x", "y", "m"), ["x"], [F.col("overlap").desc(), F.col("y")])
    band = F.when((F.col("overlap") >= 0.9) & (F.col("coverage") >= 0.4), "auto").when(F.col("overlap") >= 0.7, "review").otherwise("none")
    return best.select("x", "y", "shared", band.alias("band"))


@query("JON-27")
def fuzzy_match(spark: SparkSession, d: str) -> DataFrame:
    """Pages whose titles match by 0.75 or more within a site, with bonuses for near dates (here: numbers) and lengths; the best match of each."""
    raw = Tables(spark, d).raw("pages")
    site = F.regexp_extract(F.lower("url"), r"://[^/?#]*?([^./?#:]+\.[^./?#:]+)(?::[0-9]*)?(?:[/?#]|$)", 1)
    title = plain_title(F.regexp_extract("html", "(?is)<title>(.*?)</title>", 1))
    pages = raw.select(site.alias("key"), title.alias("title"), "page_id", F.length("html").alias("length"))
    return best_matches(pages, "page_id", "length")
