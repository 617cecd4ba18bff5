"""AGG: aggregates bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomcast.functions import scores as S
from loomcast.operators import aggregates as A
from loomcast.operators import windows as Wn
from loomcast.operators.reliable import dealt
from loomcast.operators.windows import top, top_per_group
from loomcast.plans.registry import Tables, query


def n(name: str = "n") -> Column:
    return F.count(F.lit(1)).alias(name)


@query("AGG-1", "SELECT count(*) AS n_segments, count(DISTINCT s.content_id) AS n_content, count(DISTINCT channel_id) AS n_channels FROM segments s JOIN content c USING (content_id)")
def global_counts(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    per = t.segments.groupBy("content_id").agg(n()).join(t.content.select("content_id", "channel_id"), "content_id")  # one row a content
    return per.agg(F.sum("n").alias("n_segments"), n("n_content"), F.count_distinct("channel_id").alias("n_channels"))


@query("AGG-2", "SELECT count(*) AS n FROM content WHERE platform = '3-MEDIUM' AND state = 'F'")
def count_by_filter(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).content.where("platform = '3-MEDIUM' AND state = 'F'").agg(n())


@query("AGG-3", "SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'error') AS failed, count(*) FILTER (event_type = 'purchase') AS done FROM ev GROUP BY 1")
def conditional_counts(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).events.groupBy("user_id").agg(n(), A.count_where(F.col("event_type") == "error").alias("failed"), A.count_where(F.col("event_type") == "purchase").alias("done"))


@query("AGG-4", """SELECT user_id, round(coalesce(sum(value) FILTER (event_type = 'view'), 0) / 3600, 6) AS view_hours, round(count(*) FILTER (event_type = 'click') * 5 / 60, 6) AS click_hours FROM ev GROUP BY 1""")
def conditional_sums(spark: SparkSession, d: str) -> DataFrame:
    views, clicks = A.sum_where(F.col("value"), F.col("event_type") == "view"), A.count_where(F.col("event_type") == "click")
    return Tables(spark, d).events.groupBy("user_id").agg(F.round(F.coalesce(views, F.lit(0.0)) / 3600, 6).alias("view_hours"), F.round(clicks * 5 / 60, 6).alias("click_hours"))


@query("AGG-5", "SELECT CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' ELSE event_type END AS status, count(*) AS n FROM ev GROUP BY 1")
def normalised_status(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("event_type") == "purchase", "completed").when(F.col("event_type") == "error", "failed").otherwise(F.col("event_type"))
    return Tables(spark, d).events.groupBy(status.alias("status")).agg(n())


@query("AGG-6", "SELECT platform, count(CASE WHEN state = 'F' THEN 1 END) AS done FROM content GROUP BY 1")
def count_case(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).content.groupBy("platform").agg(A.count_where(F.col("state") == "F").alias("done"))


@query("AGG-7", "SELECT count(DISTINCT CASE WHEN status = 'F' THEN content_id END) AS n FROM segments")
def count_distinct_case(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).segments.agg(F.count_distinct(F.when(F.col("status") == "F", F.col("content_id"))).alias("n"))


@query("AGG-8", """, p AS (SELECT platform, count(*) AS episodes, count(DISTINCT channel_id) AS n_channels, round(sum(duration), 2) AS duration FROM content GROUP BY 1)
SELECT * FROM p UNION ALL SELECT 'total', sum(episodes)::BIGINT, sum(n_channels)::BIGINT, round(sum(duration), 2) FROM p""")
def platform_stats(spark: SparkSession, d: str) -> DataFrame:
    """Totals add up the platforms' rows, distinct channels too."""
    p = Tables(spark, d).content.groupBy("platform").agg(n("episodes"), F.count_distinct("channel_id").alias("n_channels"), F.round(F.sum("duration"), 2).alias("duration"))
    return p.unionByName(p.agg(F.lit("total").alias("platform"), F.sum("episodes").alias("episodes"), F.sum("n_channels").alias("n_channels"), F.round(F.sum("duration"), 2).alias("duration")))


@query("AGG-9", "SELECT channel_id, count(*) AS n FROM content GROUP BY 1 ORDER BY n DESC, channel_id LIMIT 10")
def top_channels(spark: SparkSession, d: str) -> DataFrame:
    return top(Tables(spark, d).content.groupBy("channel_id").agg(n()), [F.col("n").desc(), F.col("channel_id")], 10)


@query("AGG-10", "SELECT p.s_name AS name, count(DISTINCT content_id) AS episodes FROM segments s JOIN supplier p ON p.s_suppkey = s.speaker_id GROUP BY 1 ORDER BY episodes DESC, name LIMIT 15")
def top_speakers(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    counts = t.segments.groupBy("speaker_id").agg(F.count_distinct("content_id").alias("episodes"))
    named = counts.join(t.raw("supplier").select(F.col("s_suppkey").alias("speaker_id"), F.col("s_name").alias("name")), "speaker_id").select("name", "episodes")
    return top(named, [F.col("episodes").desc(), F.col("name")], 15)


@query("AGG-11", """SELECT (SELECT count(*) FROM content) AS episodes, (SELECT count(*) FROM segments) AS n_segments, (SELECT count(*) FROM ev WHERE event_type = 'error') AS errors, (SELECT count(DISTINCT user_id) FROM ev) AS workers""")
def daily_report(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    e = t.events.agg(A.count_where(F.col("event_type") == "error").alias("errors"), F.count_distinct("user_id").alias("workers"))
    return t.content.agg(n("episodes")).crossJoin(t.segments.agg(n("n_segments"))).crossJoin(e)


@query("AGG-12", """SELECT h.project, count(DISTINCT c.content_id) AS episodes, count(DISTINCT c.channel_id) AS n_channels, strftime(min(c.publish_date), '%Y-%m-%d') AS first_day, strftime(max(c.publish_date), '%Y-%m-%d') AS last_day
FROM content c JOIN channels h USING (channel_id) GROUP BY 1""")
def project_stats(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    per = t.content.groupBy("channel_id").agg(n("episodes"), F.min("publish_date").alias("a"), F.max("publish_date").alias("b")).join(t.channels.select("channel_id", "project"), "channel_id")
    return per.groupBy("project").agg(F.sum("episodes").alias("episodes"), n("n_channels"), F.date_format(F.min("a"), "yyyy-MM-dd").alias("first_day"), F.date_format(F.max("b"), "yyyy-MM-dd").alias("last_day"))


@query("AGG-13", "SELECT strftime(ts, '%Y-%m-%d') AS day, hour(ts) AS hour, count(*) AS n FROM ev GROUP BY 1, 2")
def heatmap(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).events.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), F.hour("ts").cast("long").alias("hour")).agg(n())


@query("AGG-14", "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS hour, event_type, count(*) AS n FROM ev GROUP BY 1, 2")
def throughput(spark: SparkSession, d: str) -> DataFrame:
    hour = F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:mm")
    return Tables(spark, d).events.groupBy(hour.alias("hour"), "event_type").agg(n())


@query("AGG-15", "SELECT user_id, event_type, count(*) AS n, round((max(epoch(ts)) - min(epoch(ts))) / 3600, 2) AS hours, round(avg(value), 7) AS mean_value FROM ev GROUP BY 1, 2")
def worker_performance(spark: SparkSession, d: str) -> DataFrame:
    seconds = F.unix_micros("ts") / 1e6
    return Tables(spark, d).events.groupBy("user_id", "event_type").agg(n(), F.round((F.max(seconds) - F.min(seconds)) / 3600, 2).alias("hours"), F.round(F.avg("value"), 7).alias("mean_value"))


@query("AGG-16", "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, count(DISTINCT user_id) AS users FROM ev GROUP BY 1")
def cache_status(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).events.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(n(), F.count_distinct("user_id").alias("users"))


@query("AGG-17", "SELECT channel_id, count(*) AS n, strftime(min(publish_date), '%Y-%m-%d') AS a, strftime(max(publish_date), '%Y-%m-%d') AS b FROM content GROUP BY 1")
def channel_stats(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).content.groupBy("channel_id").agg(n(), F.date_format(F.min("publish_date"), "yyyy-MM-dd").alias("a"), F.date_format(F.max("publish_date"), "yyyy-MM-dd").alias("b"))


@query("AGG-18", """, c AS (SELECT c.channel_id, s.speaker_id, count(DISTINCT s.content_id) AS episodes FROM segments s JOIN content c USING (content_id) GROUP BY 1, 2 HAVING count(DISTINCT s.content_id) >= 2),
k AS (SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY episodes DESC, speaker_id) AS rk FROM c) SELECT channel_id, speaker_id, episodes FROM k WHERE rk <= 8""")
def regular_speakers(spark: SparkSession, d: str) -> DataFrame:
    """Of each channel the eight speakers of most episodes, two at least."""
    t = Tables(spark, d)
    n_rows = t.segments.count()
    heard = dealt(t.segments.select("content_id", "speaker_id"), n_rows, "content_id").join(dealt(t.content.select("content_id", "channel_id"), n_rows, "content_id"), "content_id")
    # Nearly every row is a group of its own until all have met: dealt first, so that no task's groups grow with the table.
    met = dealt(heard, n_rows, "channel_id", "speaker_id")
    counts = met.groupBy("channel_id", "speaker_id").agg(F.count_distinct("content_id").alias("episodes")).where("episodes >= 2")
    return top_per_group(counts, ["channel_id"], [F.col("episodes").desc(), F.col("speaker_id")], 8)


@query("AGG-19", """SELECT channel_id, rank() OVER (ORDER BY score DESC) AS rank, CASE WHEN score >= 8000 THEN 'A' WHEN score >= 3000 THEN 'B' ELSE 'C' END AS tier FROM channels""")
def ranked_tiers(spark: SparkSession, d: str) -> DataFrame:
    out = Wn.competition_rank(Tables(spark, d).channels.select("channel_id", "score"), "score")
    return out.select("channel_id", "rank", S.bands(F.col("score"), [(3000, "B"), (8000, "A")], "C").alias("tier"))


@query("AGG-20", """, m AS (SELECT channel_id, strftime(publish_date, '%Y-%m') AS month, sum(duration) AS total FROM content GROUP BY 1, 2), l AS (SELECT max(month) AS month FROM m)
SELECT channel_id, month, round(total, 2) AS total FROM m JOIN l USING (month) ORDER BY m.total DESC, channel_id LIMIT 10""")
def latest_month(spark: SparkSession, d: str) -> DataFrame:
    c = Tables(spark, d).content
    month = F.date_format("publish_date", "yyyy-MM")
    last = c.agg(F.date_trunc("month", F.max("publish_date")).alias("from"))  # one row
    kept = c.join(F.broadcast(last), F.col("publish_date") >= F.col("from")).groupBy("channel_id", month.alias("month")).agg(F.sum("duration").alias("x"))
    return top(kept, [F.col("x").desc(), F.col("channel_id")], 10).select("channel_id", "month", F.round("x", 2).alias("total"))


@query("AGG-21", "SELECT coalesce(lang, 'unknown') AS lang, count(*) AS n FROM documents GROUP BY 1")
def languages(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).documents.groupBy(F.coalesce("lang", F.lit("unknown")).alias("lang")).agg(n())


@query("AGG-22", "SELECT count(DISTINCT channel_id) AS a, count(DISTINCT platform) AS b, count(DISTINCT state) AS c, count(DISTINCT date_trunc('month', publish_date)) AS d FROM content")
def chart_coverage(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).content.agg(F.count_distinct("channel_id").alias("a"), F.count_distinct("platform").alias("b"), F.count_distinct("state").alias("c"), F.count_distinct(F.date_trunc("month", "publish_date")).alias("d"))


PJ = """, pj AS (SELECT c.content_id, c.duration, unnest(list_distinct(list(h.project))) AS project FROM content c JOIN channels h ON h.channel_id IN (c.channel_id, c.channel_id + 1) GROUP BY 1, 2)
"""


@query("AGG-23", PJ + "SELECT project, round(sum(duration), 2) AS total FROM pj GROUP BY 1")
def totals_by_project(spark: SparkSession, d: str) -> DataFrame:
    from loomcast.plans.filters import with_projects

    t = Tables(spark, d)
    rows = with_projects(t).select("content_id", F.explode("projects").alias("project")).join(t.content.select("content_id", "duration"), "content_id")
    return rows.groupBy("project").agg(F.round(F.sum("duration"), 2).alias("total"))


@query("AGG-24", "SELECT c.content_id, round(max(s.length) / nullif(c.duration, 0), 8) AS covered FROM content c JOIN segments s USING (content_id) GROUP BY 1, c.duration HAVING max(s.length) / nullif(c.duration, 0) < 0.0005")
def chunk_coverage(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    last = t.segments.groupBy("content_id").agg(F.max("length").alias("m"))
    ratio = F.try_divide(F.col("m"), F.nullif(F.col("duration"), F.lit(0.0)))
    return t.content.join(last, "content_id").withColumn("x", ratio).where("x < 0.0005").select("content_id", F.round("x", 8).alias("covered"))


@query("AGG-25", """SELECT channel_id, count(DISTINCT platform) AS charts, min(duration) AS best, string_agg(DISTINCT platform, ',' ORDER BY platform) AS names FROM content GROUP BY 1 HAVING count(DISTINCT platform) >= 4""")
def chart_candidates(spark: SparkSession, d: str) -> DataFrame:
    out = Tables(spark, d).content.groupBy("channel_id").agg(F.array_sort(F.collect_set("platform")).alias("p"), F.min("duration").alias("best")).where(F.size("p") >= 4)
    return out.select("channel_id", F.size("p").cast("long").alias("charts"), "best", F.array_join("p", ",").alias("names"))


@query("AGG-26", "SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS said FROM conversations WHERE role = 'user' GROUP BY 1")
def ordered_text(spark: SparkSession, d: str) -> DataFrame:
    held = Tables(spark, d).turns.where("role = 'user'").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("t"))
    return held.select("conv_id", F.array_join("t.text", " ").alias("said"))


@query("AGG-27", "SELECT speaker_id, array_to_string(list_sort(list(DISTINCT emotion) FILTER (length > 25)), ',') AS emotions FROM segments GROUP BY 1")
def distinct_filtered(spark: SparkSession, d: str) -> DataFrame:
    kept = F.sort_array(F.collect_set(F.when(F.col("length") > 25, F.col("emotion"))))
    return Tables(spark, d).segments.groupBy("speaker_id").agg(F.array_join(kept, ",").alias("emotions"))


@query("AGG-28", "SELECT content_id, array_to_string(list(segment_id ORDER BY confidence DESC, segment_id), ',') AS ids FROM segments GROUP BY 1")
def ordered_ids(spark: SparkSession, d: str) -> DataFrame:
    held = F.sort_array(F.collect_list(F.struct((-F.col("confidence")).alias("c"), "segment_id")))
    return Tables(spark, d).segments.groupBy("content_id").agg(held.alias("h")).select("content_id", F.array_join(F.transform("h", lambda x: x["segment_id"].cast("string")), ",").alias("ids"))


@query("AGG-29", "SELECT label, count(*) AS n, round(100.0 * count(*) / nullif((SELECT count(*) FROM vec), 0), 4) AS percentage FROM vec GROUP BY 1")
def cluster_status(spark: SparkSession, d: str) -> DataFrame:
    v = Tables(spark, d).vectors
    return v.groupBy("label").agg(n()).crossJoin(F.broadcast(v.agg(n("all")))).select("label", "n", F.round(100.0 * F.col("n") / F.nullif(F.col("all"), F.lit(0)), 4).alias("percentage"))


@query("AGG-30", "SELECT p.s_suppkey AS speaker_id, count(s.segment_id) AS n, round(coalesce(sum(s.length), 0), 2) AS total FROM supplier p LEFT JOIN segments s ON s.speaker_id = p.s_suppkey GROUP BY 1")
def identity_summary(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    sums = t.segments.groupBy("speaker_id").agg(n(), F.sum("length").alias("x"))
    out = t.raw("supplier").select(F.col("s_suppkey").alias("speaker_id")).join(sums, "speaker_id", "left")
    return out.select("speaker_id", F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.round(F.coalesce("x", F.lit(0.0)), 2).alias("total"))


@query("AGG-31", """, g AS (SELECT source, count(*) AS n, min(doc_id) AS f FROM documents GROUP BY 1) SELECT source, n, round(100.0 * n / (SELECT count(*) FROM documents), 4) AS percentage FROM g ORDER BY n DESC, f LIMIT 10""")
def source_distribution(spark: SparkSession, d: str) -> DataFrame:
    return A.distribution(Tables(spark, d).documents, "source", 10, "doc_id").withColumn("percentage", F.round("percentage", 4))


@query("AGG-32", "SELECT strftime(ts, '%Y-W%U') AS bucket, count(*) AS n FROM ev GROUP BY 1")
def temporal(spark: SparkSession, d: str) -> DataFrame:
    return A.temporal_buckets(Tables(spark, d).events, "ts")


@query("AGG-33", """, g AS (SELECT speaker_id, count(*) AS n FROM segments GROUP BY 1), t AS (SELECT sum(n)::DOUBLE AS a FROM g), r AS (SELECT n, row_number() OVER (ORDER BY n DESC, speaker_id) AS rn FROM g)
SELECT count(*) AS n_groups, round(sum((n / a * 100) * (n / a * 100)), 4) AS hhi, round(100 * sum(n) FILTER (rn <= 3) / any_value(a), 4) AS top3_share, round(100 * sum(n) FILTER (rn <= 10) / any_value(a), 4) AS top10_share,
CASE WHEN sum((n / a * 100) * (n / a * 100)) >= 2500 THEN 'high' WHEN sum((n / a * 100) * (n / a * 100)) >= 1500 THEN 'moderate' ELSE 'low' END AS level FROM r, t""")
def concentration(spark: SparkSession, d: str) -> DataFrame:
    out = A.concentration(Tables(spark, d).segments, "speaker_id")
    return out.select("n_groups", *[F.round(c, 4).alias(c) for c in ("hhi", "top3_share", "top10_share")], "level")


@query("AGG-34", """, g AS (SELECT source, least(100, 100.0 * count(*) / (SELECT count(*) FROM documents) * 4) AS c FROM documents GROUP BY 1)
SELECT source, CASE WHEN c >= 50 THEN 5 WHEN c >= 30 THEN 4 WHEN c >= 15 THEN 3 WHEN c >= 5 THEN 2 WHEN c >= 1 THEN 1 ELSE 0 END AS level FROM g""")
def centrality(spark: SparkSession, d: str) -> DataFrame:
    docs = Tables(spark, d).documents
    shares = docs.groupBy("source").agg(n()).crossJoin(F.broadcast(docs.agg(n("all"))))
    return shares.select("source", A.centrality_level(F.least(F.lit(100.0), 400.0 * F.col("n") / F.col("all"))).alias("level"))


@query("AGG-35", "SELECT channel_id, CASE WHEN sum(duration) = 0 THEN NULL ELSE round(sum(duration) / 3600, 2) END AS hours FROM content GROUP BY 1")
def total_hours(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).content.groupBy("channel_id").agg(F.round(F.nullif(F.sum("duration"), F.lit(0.0)) / 3600, 2).alias("hours"))


@query("AGG-36", "SELECT platform, count(DISTINCT channel_id) AS items, round(avg(duration), 3) AS mean_length, round(sum(duration), 2) AS total, strftime(min(publish_date), '%Y-%m-%d') AS a, strftime(max(publish_date), '%Y-%m-%d') AS b FROM content GROUP BY 1")
def group_stats(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).content.groupBy("platform").agg(
        F.count_distinct("channel_id").alias("items"), F.round(F.avg("duration"), 3).alias("mean_length"), F.round(F.sum("duration"), 2).alias("total"),
        F.date_format(F.min("publish_date"), "yyyy-MM-dd").alias("a"), F.date_format(F.max("publish_date"), "yyyy-MM-dd").alias("b"),
    )


@query("AGG-37", """, m AS (SELECT strftime(segment_date, '%Y-%m') AS month, emotion, unnest([theme_id % 5, speaker_id % 5]) AS theme FROM segments), g AS (SELECT month, emotion, theme, count(*) AS n FROM m GROUP BY 1, 2, 3)
SELECT month, emotion, theme, n, round(n / sum(n) OVER (PARTITION BY month), 6) AS share FROM g""")
def theme_trends(spark: SparkSession, d: str) -> DataFrame:
    s = Tables(spark, d).segments
    rows = s.select(F.date_format("segment_date", "yyyy-MM").alias("month"), "emotion", F.explode(F.array(F.col("theme_id") % 5, F.col("speaker_id") % 5)).alias("theme"))
    g = rows.groupBy("month", "emotion", "theme").agg(n())
    return g.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("month")), 6))


@query("AGG-38", """SELECT strftime(segment_date, '%Y-%m-%d') AS day, round(coalesce(sum(length) FILTER (emotion = 'A'), 0), 2) AS A, round(coalesce(sum(length) FILTER (emotion = 'N'), 0), 2) AS N, round(coalesce(sum(length) FILTER (emotion = 'R'), 0), 2) AS R,
round(100 * coalesce(sum(length) FILTER (emotion = 'A'), 0) / sum(length), 4) AS A_pct, round(100 * coalesce(sum(length) FILTER (emotion = 'N'), 0) / sum(length), 4) AS N_pct, round(100 * coalesce(sum(length) FILTER (emotion = 'R'), 0) / sum(length), 4) AS R_pct FROM segments GROUP BY 1""")
def sentiment_hours(spark: SparkSession, d: str) -> DataFrame:
    s = Tables(spark, d).segments.select(F.date_format("segment_date", "yyyy-MM-dd").alias("day"), "emotion", "length")
    out = A.pivot_share(s, "day", "emotion", ["A", "N", "R"], "length")
    return out.select("day", *[F.round(c, 2).alias(c) for c in "ANR"], *[F.round(f"{c}_pct", 4).alias(f"{c}_pct") for c in "ANR"])


@query("AGG-39", "SELECT content_id, emotion, count(*) AS n FROM segments WHERE emotion NOT IN ('N') AND confidence > 0.03 GROUP BY 1, 2")
def emotion_counts(spark: SparkSession, d: str) -> DataFrame:
    g = Tables(spark, d).segments.where((F.col("emotion") != "N") & (F.col("confidence") > 0.03)).groupBy("content_id", "emotion").agg(n())
    return g.groupBy("content_id").agg(F.map_from_entries(F.collect_list(F.struct("emotion", "n"))).alias("m")).select("content_id", F.explode("m").alias("emotion", "n"))


@query("AGG-40", "SELECT lang, round(avg(n_chars), 3) AS mean, min(n_chars) AS least, max(n_chars) AS most FROM documents GROUP BY 1")
def token_stats(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).documents.groupBy("lang").agg(F.round(F.avg("n_chars"), 3).alias("mean"), F.min("n_chars").alias("least"), F.max("n_chars").alias("most"))


@query("AGG-41", """, r AS (SELECT channel_id, platform AS chart, 1 + content_id % 100 AS rank, (2001 - year(publish_date)) * 12 + (8 - month(publish_date)) AS age FROM content WHERE publish_date >= TIMESTAMP '2001-01-01'),
x AS (SELECT channel_id, chart, max(greatest(0, 101.0 - rank) * CASE WHEN chart = '1-URGENT' THEN 1.5 ELSE 1.0 END * pow(0.9, age)) AS p FROM (SELECT channel_id, chart, min(rank) AS rank, age FROM r GROUP BY 1, 2, 4) GROUP BY 1, 2)
SELECT channel_id, round(sum(p), 7) AS importance FROM x GROUP BY 1""")
def importance_score(spark: SparkSession, d: str) -> DataFrame:
    c = Tables(spark, d).content.where(F.col("publish_date") >= "2001-01-01")
    best = c.groupBy("channel_id", F.date_format("publish_date", "yyyy-MM").alias("month"), "platform").agg(F.min(1 + F.col("content_id") % 100).alias("rank"))
    charts = best.groupBy("channel_id", "month").agg(F.map_from_entries(F.collect_list(F.struct("platform", "rank"))).alias("c"))
    maps = charts.groupBy("channel_id").agg(F.map_from_entries(F.collect_list(F.struct("month", "c"))).alias("rankings"))
    return A.importance(maps, "channel_id", "rankings", "2001-08", {"1-URGENT": 1.5}, digits=7)


@query("AGG-42", "SELECT event_type, count(*) AS n, count(*) FILTER (ts >= TIMESTAMP '2024-01-24') AS recent, round(avg(value), 4) AS mean, max(k) AS most FROM ev GROUP BY 1")
def cache_statistics(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).events.groupBy("event_type").agg(n(), A.count_where(F.col("ts") >= "2024-01-24").alias("recent"), F.round(F.avg("value"), 4).alias("mean"), F.max("k").alias("most"))


@query("AGG-43", "SELECT count(DISTINCT h.channel_id) AS variations, sum(c.content_id % 7)::BIGINT AS uses, count(DISTINCT c.content_id) AS expansions FROM channels h LEFT JOIN content c USING (channel_id)")
def variation_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Sums after the fan-out of a left join, so a variation counts once for each of its expansions."""
    t = Tables(spark, d)
    return t.channels.join(t.content, "channel_id", "left").agg(F.count_distinct("channel_id").alias("variations"), F.sum(F.col("content_id") % 7).alias("uses"), F.count_distinct("content_id").alias("expansions"))


@query("AGG-44", "SELECT user_id % 10 AS worker, event_type AS status, count(*) AS n FROM ev GROUP BY 1, 2")
def worker_stats(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).events.groupBy((F.col("user_id") % 10).alias("worker"), F.col("event_type").alias("status")).agg(n())


@query("AGG-45", "SELECT platform, state, strftime(publish_date, '%Y-%m') AS month, count(*) AS n FROM content GROUP BY 1, 2, 3")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).content.groupBy("platform", "state", F.date_format("publish_date", "yyyy-MM").alias("month")).agg(n())


@query("AGG-46", ", m AS (SELECT text, min(doc_id) AS f FROM documents GROUP BY 1) SELECT sum(CASE WHEN d.doc_id = m.f THEN n_chars ELSE 0 END)::BIGINT AS unique_chars FROM documents d JOIN m USING (text)")
def unique_duration(spark: SparkSession, d: str) -> DataFrame:
    docs = Tables(spark, d).documents
    first = docs.groupBy(F.sha2("text", 256).alias("h")).agg(F.min(F.struct("doc_id", "n_chars")).alias("m"))
    return first.agg(F.sum("m.n_chars").alias("unique_chars"))


@query("AGG-48", """, e AS (SELECT user_id, count(*) FILTER (ts >= TIMESTAMP '2024-01-30 23:00:00') AS hour1, count(*) FILTER (ts >= TIMESTAMP '2024-01-30') AS day1, count(DISTINCT event_type) AS kinds,
  round(100.0 * count(*) FILTER (event_type = 'error') / count(*), 4) AS error_pct, round(avg(value), 4) AS latency, count(*) AS n FROM ev GROUP BY 1) SELECT * FROM e ORDER BY n DESC, user_id LIMIT 10""")
def api_usage(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events.groupBy("user_id").agg(
        A.count_where(F.col("ts") >= "2024-01-30 23:00:00").alias("hour1"), A.count_where(F.col("ts") >= "2024-01-30").alias("day1"), F.count_distinct("event_type").alias("kinds"),
        F.round(F.try_divide(100.0 * A.count_where(F.col("event_type") == "error"), F.count(F.lit(1))), 4).alias("error_pct"), F.round(F.avg("value"), 4).alias("latency"), n(),
    )
    return top(e, [F.col("n").desc(), F.col("user_id")], 10)


@query("AGG-49", """, f AS (SELECT *, CASE WHEN role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn) THEN 1 ELSE 0 END AS new FROM conversations)
SELECT conv_id, role, sum(len(string_split(text, ' ')))::BIGINT AS words, sum(new)::BIGINT AS runs, min(turn) AS a, max(turn) AS b FROM f GROUP BY 1, 2""")
def speaker_metrics(spark: SparkSession, d: str) -> DataFrame:
    r = Wn.runs(Tables(spark, d).turns, ["conv_id"], ["turn"], "role")
    return r.groupBy("conv_id", "role").agg(F.sum(F.size(F.split("text", " "))).alias("words"), F.count_distinct("run").alias("runs"), F.min("turn").alias("a"), F.max("turn").alias("b"))


@query("AGG-50", "SELECT trim(emotion) AS host, count(*) AS n, count(DISTINCT content_id) AS episodes, array_to_string(list_sort(list(DISTINCT speaker_id % 10)), ',') AS names FROM segments WHERE trim(emotion) <> '' GROUP BY 1")
def host_frequency(spark: SparkSession, d: str) -> DataFrame:
    hosts = Tables(spark, d).segments.groupBy("content_id").agg(F.collect_list(F.struct(F.col("emotion").alias("name"), (F.col("speaker_id") % 10).alias("who"))).alias("hosts"))
    rows = hosts.select("content_id", F.inline("hosts")).withColumn("host", F.trim("name")).where("host <> ''")
    return rows.groupBy("host").agg(n(), F.count_distinct("content_id").alias("episodes"), F.array_join(F.sort_array(F.collect_set("who")).cast("array<string>"), ",").alias("names"))


@query("AGG-47", """SELECT platform, state, count(*) AS n, round(sum(duration), 2) AS total FROM content GROUP BY ROLLUP (platform, state)""")
def rolled_up(spark: SparkSession, d: str) -> DataFrame:
    """Grouping sets, which Spark offers by itself."""
    return Tables(spark, d).content.rollup("platform", "state").agg(n(), F.round(F.sum("duration"), 2).alias("total"))
