"""SNK, STR and UDF: new states of tables, streaming-like operators and user functions bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.functions import text as X
from loomcast.operators import windows as Wn
from loomcast.operators.windows import top, top_per_group
from loomcast.plans.files import folder
from loomcast.plans.registry import Tables, query
from loomcast.sources import sinks as K
from loomcast.streaming import streams as St
from loomcast.streaming.maintained import run_maintained

NOW = "2024-01-31 00:00:00"
REFRESH = """, c0 AS (SELECT event_id, ts FROM ev WHERE event_id % 7 <> 0 AND NOT (day(ts) = 28 AND event_id % 3 = 0)), keep AS (SELECT * FROM c0 WHERE ts >= TIMESTAMP '{now}' - INTERVAL {days} DAYS),
src AS (SELECT event_id, ts FROM ev WHERE ts >= TIMESTAMP '{now}' - INTERVAL {days} DAYS), s AS (SELECT ts::DATE AS d, count(*) AS n FROM src GROUP BY 1), k AS (SELECT ts::DATE AS d, count(*) AS n FROM keep GROUP BY 1),
gap AS (SELECT s.d FROM s LEFT JOIN k USING (d) WHERE coalesce(k.n, 0) < s.n * 0.8)
SELECT event_id FROM keep UNION SELECT event_id FROM src WHERE ts::DATE IN (SELECT d FROM gap) OR ts >= TIMESTAMP '{now}' - INTERVAL {hours} HOURS"""


def refreshed(t: Tables, days: int, hours: int) -> DataFrame:
    source = t.events.select("event_id", "ts", F.col("ts").alias("updated"))
    cache = source.where("event_id % 7 <> 0 AND NOT (day(ts) = 28 AND event_id % 3 = 0)")
    return K.refresh_window(cache, source, "event_id", "ts", "updated", NOW, days, hours, 0.8).select("event_id")


@query("SNK-1", REFRESH.format(now="2024-01-31", days=30, hours=12))
def refresh_30(spark: SparkSession, d: str) -> DataFrame:
    return refreshed(Tables(spark, d), 30, 12)


@query("SNK-2", REFRESH.format(now="2024-01-31", days=7, hours=2))
def refresh_7(spark: SparkSession, d: str) -> DataFrame:
    return refreshed(Tables(spark, d), 7, 2)


STATES = ", o AS (SELECT user_id, max(k) AS k, count(*) AS uses FROM ev WHERE event_type = 'view' GROUP BY 1), n AS (SELECT user_id, max(k) AS k, count(*) AS uses FROM ev WHERE event_type = 'signup' GROUP BY 1) "


def states(t: Tables) -> tuple[DataFrame, DataFrame]:
    per = lambda kind: t.events.where(F.col("event_type") == kind).groupBy("user_id").agg(F.max("k").alias("k"), F.count(F.lit(1)).alias("uses"))
    return per("view"), per("signup")


@query("SNK-3", STATES + "SELECT coalesce(o.user_id, n.user_id) AS user_id, CASE WHEN n.user_id IS NOT NULL THEN n.k ELSE o.k END AS k, coalesce(o.uses, 0) + coalesce(n.uses, 0) AS uses FROM o FULL JOIN n ON o.user_id = n.user_id")
def upsert_update(spark: SparkSession, d: str) -> DataFrame:
    return K.upsert(*states(Tables(spark, d)), ["user_id"], counters=["uses"])


@query("SNK-4", STATES + "SELECT coalesce(o.user_id, n.user_id) AS user_id, coalesce(o.k, n.k) AS k, coalesce(o.uses, 0) + coalesce(n.uses, 0) AS uses FROM o FULL JOIN n ON o.user_id = n.user_id")
def upsert_keep(spark: SparkSession, d: str) -> DataFrame:
    return K.upsert(*states(Tables(spark, d)), ["user_id"], keep_old=["k"], counters=["uses"])


INSERT = STATES + "SELECT * FROM o UNION ALL SELECT * FROM n WHERE user_id NOT IN (SELECT user_id FROM o)"


@query("SNK-5", INSERT)
def insert_nothing(spark: SparkSession, d: str) -> DataFrame:
    return K.insert_new(*states(Tables(spark, d)), ["user_id"])


@query("SNK-6", ", o AS (SELECT user_id, event_type, min(event_id) AS event_id FROM ev WHERE event_id % 2 = 0 GROUP BY 1, 2), n AS (SELECT user_id, event_type, min(event_id) AS event_id FROM ev WHERE event_id % 2 = 1 GROUP BY 1, 2) SELECT * FROM o UNION ALL SELECT n.* FROM n ANTI JOIN o USING (user_id, event_type)")
def add_tasks(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events.select("user_id", "event_type", "event_id")
    old = e.where("event_id % 2 = 0").groupBy("user_id", "event_type").agg(F.min("event_id").alias("event_id"))
    return K.insert_new(old, e.where("event_id % 2 = 1"), ["user_id", "event_type"], [F.col("event_id")])


@query("SNK-7", "SELECT DISTINCT content_id, speaker_id % 3 AS schema_id FROM segments")
def bulk_candidates(spark: SparkSession, d: str) -> DataFrame:
    s = Tables(spark, d).segments.select("content_id", (F.col("speaker_id") % 3).alias("schema_id"))
    return K.insert_new(s.limit(0), s, ["content_id", "schema_id"])


@query("SNK-8", ", p AS (SELECT content_id, bool_and(status = 'F') AS done FROM segments GROUP BY 1) SELECT c.content_id, p.done FROM content c JOIN p USING (content_id) WHERE p.done IS DISTINCT FROM (c.state = 'F')")
def changed_only(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    done = t.segments.groupBy("content_id").agg(F.bool_and(F.col("status") == "F").alias("done"))
    return t.content.join(done, "content_id").where(~F.col("done").eqNullSafe(F.col("state") == "F")).select("content_id", "done")


@query("SNK-9", "SELECT content_id, bool_and(confidence > 0) AS embedded FROM segments GROUP BY 1")
def all_embedded(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).segments.groupBy("content_id").agg(F.bool_and(F.col("confidence") > 0).alias("embedded"))


@query("SNK-10", ", r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM ev WHERE event_type IN ('view', 'click')) SELECT event_id FROM ev WHERE event_type NOT IN ('view', 'click') UNION ALL SELECT event_id FROM r WHERE rn = 1")
def duplicates_deleted(spark: SparkSession, d: str) -> DataFrame:
    pending = F.col("event_type").isin("view", "click")
    return K.keep_first(Tables(spark, d).events, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")], pending).select("event_id")


@query("SNK-11", "SELECT segment_id FROM segments WHERE content_id NOT IN (SELECT content_id FROM content WHERE state = 'P')")
def cascade(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return K.without(t.segments, t.content.where("state = 'P'"), ["content_id"]).select("segment_id")


@query("SNK-12", """, s AS (SELECT *, CASE WHEN status = 'F' THEN length + 1 ELSE length END AS l FROM segments WHERE emotion <> 'R')
SELECT speaker_id, count(*) AS n, sum(l)::DOUBLE AS total, count(DISTINCT content_id) AS units, arg_max(content_id, (segment_date, content_id)) AS last_unit FROM s GROUP BY 1""")
def maintained_totals(spark: SparkSession, d: str) -> DataFrame:
    """Speakers' totals moved by a feed of three batches of files: all segments come, those of one status grow, those of one emotion go."""
    old = Tables(spark, d).segments.select("speaker_id", "content_id", "segment_date", "emotion", "status", F.col("length").cast("decimal(18,2)").alias("length"))
    new = old.withColumn("length", F.when(F.col("status") == "F", F.col("length") + 1).otherwise(F.col("length")))
    signed = lambda rows, sign: rows.select("speaker_id", "content_id", "segment_date", F.col("length").cast("decimal(18,2)").alias("length"), F.lit(sign).alias("sign"))
    path, changed = folder(spark), F.col("status") == "F"
    for rows in (signed(old, 1), signed(old.where(changed), -1).unionByName(signed(new.where(changed), 1)), signed(new.where("emotion = 'R'"), -1)):
        rows.write.mode("append").parquet(f"{path}/feed")  # as many files as the input has parts; what has come since the last run is a batch
        stream = spark.readStream.schema(signed(old, 1).schema).parquet(f"{path}/feed")
        out = run_maintained(stream, f"{path}/kept", "speaker_id", "content_id", "segment_date", "length")
    return out.select("speaker_id", "n", F.col("total").cast("double").alias("total"), "units", "last_unit")


@query("SNK-12-MERGE", "SELECT speaker_id, count(*) AS n, round(sum(length), 2) AS total FROM segments GROUP BY 1")
def maintained(spark: SparkSession, d: str) -> DataFrame:
    """Counters merged: what was counted before a date, and what came after it added on."""
    s, date = Tables(spark, d).segments, F.lit("1998-01-01").cast("timestamp")
    per = lambda rows: rows.groupBy("speaker_id").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("total"))
    kept = K.upsert(per(s.where(F.col("segment_date") < date)), per(s.where(F.col("segment_date") >= date)), ["speaker_id"], counters=["n", "total"])
    return kept.select("speaker_id", "n", F.round("total", 2).alias("total"))


@query("SNK-13", "SELECT speaker_id, arg_max(content_id, (segment_date, segment_id)) AS last_content, count(DISTINCT content_id) AS episodes FROM segments GROUP BY 1")
def recomputed(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).segments.groupBy("speaker_id").agg(F.max_by("content_id", F.struct("segment_date", "segment_id")).alias("last_content"), F.count_distinct("content_id").alias("episodes"))


@query("SNK-14", "SELECT segment_id, left(md5(content_id::VARCHAR || '|' || idx::VARCHAR), 8) AS h FROM segments")
def hash_keys(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).segments.select("segment_id", X.short_hash(F.col("content_id").cast("string"), F.col("idx").cast("string")).alias("h"))


@query("SNK-16", "SELECT event_id FROM ev WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAYS")
def retention(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).events.where(F.col("ts") >= F.lit(NOW).cast("timestamp") - F.expr("INTERVAL 7 DAYS")).select("event_id")


@query("SNK-18", "SELECT content_id, string_agg('Q' || theme_id || ':' || confidence::DECIMAL(4,2), ';' ORDER BY theme_id, confidence) AS themes FROM segments WHERE theme_id % 2 = 0 GROUP BY 1")
def export_segments(spark: SparkSession, d: str) -> DataFrame:
    held = F.array_sort(F.collect_list(F.struct("theme_id", "confidence")))
    kept = Tables(spark, d).segments.groupBy("content_id").agg(held.alias("h")).select("content_id", F.filter("h", lambda x: x["theme_id"] % 2 == 0).alias("h")).where(F.size("h") > 0)
    text = F.transform("h", lambda x: F.concat(F.lit("Q"), x["theme_id"].cast("string"), F.lit(":"), x["confidence"].cast("decimal(4,2)").cast("string")))
    return kept.select("content_id", F.array_join(text, ";").alias("themes"))


@query("SNK-20", "SELECT platform, count(*) AS n, round(sum(duration), 2) AS total FROM content GROUP BY 1")
def export_json(spark: SparkSession, d: str) -> DataFrame:
    c = Tables(spark, d).content.groupBy("platform").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("duration"), 2).alias("total"))
    doc = K.nested_document(c.withColumn("all", F.lit(1)), "all", ["platform", "n", "total"])
    return doc.select(F.inline(F.from_json("document", "n bigint, rows array<struct<platform:string,n:bigint,total:double>>")["rows"]))


@query("SNK-21", "SELECT channel_id, min(duration) AS best, count(*) AS n FROM content GROUP BY 1 HAVING count(*) >= 5 ORDER BY best, channel_id LIMIT 25")
def export_ranked(spark: SparkSession, d: str) -> DataFrame:
    g = Tables(spark, d).content.groupBy("channel_id").agg(F.min("duration").alias("best"), F.count(F.lit(1)).alias("n")).where("n >= 5")
    return top(g, [F.col("best"), F.col("channel_id")], 25)


@query("SNK-25", STATES + "SELECT coalesce(o.user_id, n.user_id) AS user_id, CASE WHEN n.user_id IS NOT NULL THEN n.k ELSE o.k END AS k, CASE WHEN n.user_id IS NOT NULL THEN n.uses ELSE o.uses END AS uses FROM o FULL JOIN n ON o.user_id = n.user_id")
def bookmark_upsert(spark: SparkSession, d: str) -> DataFrame:
    return K.upsert(*states(Tables(spark, d)), ["user_id"])


@query("STR-1", ", l AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS rn FROM ev WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 12 HOURS) SELECT event_id FROM l WHERE rn = 1")
def incremental(spark: SparkSession, d: str) -> DataFrame:
    fresh = Tables(spark, d).events.where(F.col("ts") >= F.lit(NOW).cast("timestamp") - F.expr("INTERVAL 12 HOURS"))
    return top_per_group(fresh, ["user_id", "event_type"], [F.col("ts").desc(), F.col("event_id")]).select("event_id")


@query("STR-2", "SELECT event_id FROM ev WHERE ts >= (SELECT max(ts) FROM ev) - INTERVAL 7 DAYS")
def aged(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events
    return e.join(F.broadcast(e.agg(F.max("ts").alias("m"))), F.col("ts") >= F.col("m") - F.expr("INTERVAL 7 DAYS")).select("event_id")


@query("STR-3", ", c0 AS (SELECT event_id, ts FROM ev WHERE NOT (day(ts) IN (10, 20) AND event_id % 3 = 0)), s AS (SELECT ts::DATE AS d, count(*) AS n FROM ev GROUP BY 1), k AS (SELECT ts::DATE AS d, count(*) AS n FROM c0 GROUP BY 1) SELECT strftime(s.d, '%Y-%m-%d') AS day, s.n AS n_source, k.n AS n_cache FROM s LEFT JOIN k USING (d) WHERE coalesce(k.n, 0) < s.n * 0.9")
def gaps(spark: SparkSession, d: str) -> DataFrame:
    from loomcast.operators.aggregates import gap_days

    e = Tables(spark, d).events
    return gap_days(e, e.where("NOT (day(ts) IN (10, 20) AND event_id % 3 = 0)"), "ts", "ts").withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("STR-4", "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS hour, event_type, count(*) AS n, round(sum(value), 4) AS total FROM ev GROUP BY 1, 2")
def hourly(spark: SparkSession, d: str) -> DataFrame:
    out = Tables(spark, d).events.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return out.select(F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("hour"), "event_type", "n", "total")


def event_stream(spark: SparkSession, d: str) -> DataFrame:
    """The events table as a stream of its files."""
    schema = Tables(spark, d).raw("events").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d) if not _is_folder(spark, f"{d}/events.parquet") else St.read_files(spark, f"{d}/events.parquet", schema)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def _is_folder(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory()


@query("STR-4-STREAM", "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS hour, event_type, count(*) AS n, round(sum(value), 4) AS total FROM ev GROUP BY 1, 2")
def hourly_stream(spark: SparkSession, d: str) -> DataFrame:
    """STR-4 as a stream, a backfill: no row is too late."""
    counts = St.tumbling_counts(event_stream(spark, d), "ts", "event_type", "1 hour", "3650 days")
    out = St.run_updates(counts, folder(spark), ["start", "event_type"])
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("hour"), "event_type", "n", F.round("total", 4).alias("total"))


@query("STR-12-STREAM", "SELECT strftime(s, '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL 6 HOURS, ts), time_bucket(INTERVAL 6 HOURS, ts) - INTERVAL 6 HOURS]) AS s FROM ev) GROUP BY 1, 2")
def sliding_stream(spark: SparkSession, d: str) -> DataFrame:
    """Windows of twelve hours, a new one every six."""
    counts = St.sliding_counts(event_stream(spark, d), "ts", "event_type", "12 hours", "6 hours", "3650 days")
    out = St.run_updates(counts, folder(spark), ["start", "event_type"])
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n")


@query("STR-5", """, f AS (SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w THEN 1 ELSE 0 END AS new FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM f) SELECT user_id, run::BIGINT AS run, any_value(event_type) AS event_type, count(*) AS n FROM g GROUP BY 1, 2""")
def sessionised(spark: SparkSession, d: str) -> DataFrame:
    r = Wn.runs(Tables(spark, d).events, ["user_id"], ["ts", "event_id"], "event_type")
    return r.groupBy("user_id", "run").agg(F.first("event_type").alias("event_type"), F.count(F.lit(1)).alias("n"))


LAST = ", l AS (SELECT user_id, max(ts) AS ts, arg_max(event_type, (ts, event_id)) AS event_type FROM ev GROUP BY 1) "


def last_seen(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(F.max("ts").alias("ts"), F.max_by("event_type", F.struct("ts", "event_id")).alias("event_type"))


@query("STR-6", LAST + "SELECT user_id FROM l WHERE epoch(TIMESTAMP '2024-01-31') - floor(epoch(ts)) > 21600")
def heartbeat(spark: SparkSession, d: str) -> DataFrame:
    return St.stale(last_seen(Tables(spark, d)), "ts", NOW, {}, 21600).select("user_id")


@query("STR-7", LAST + "SELECT user_id FROM l WHERE epoch(TIMESTAMP '2024-01-31') - floor(epoch(ts)) > CASE event_type WHEN 'view' THEN 3600 WHEN 'error' THEN 60 ELSE 14400 END")
def per_type_timeout(spark: SparkSession, d: str) -> DataFrame:
    return St.stale(last_seen(Tables(spark, d)), "ts", NOW, {"view": 3600, "error": 60}, 14400).select("user_id")


@query("STR-9", """, r AS (SELECT user_id, event_id, epoch(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM ev),
w(user_id, rn, s, used) AS (SELECT user_id, rn, t, 1 FROM r WHERE rn = 1 UNION ALL SELECT r.user_id, r.rn, CASE WHEN r.t >= w.s + 86400 THEN r.t ELSE w.s END, CASE WHEN r.t >= w.s + 86400 THEN 1 ELSE w.used + 1 END FROM w JOIN r ON r.user_id = w.user_id AND r.rn = w.rn + 1)
SELECT r.event_id, w.used <= 3 AS allowed FROM w JOIN r USING (user_id, rn)""")
def rate_window(spark: SparkSession, d: str) -> DataFrame:
    """The batch form: windows that restart at the first request a day or more after their start, three requests each."""
    from loomcast.operators.ranges import scan_groups

    def judge():
        start, used = -1e18, 0

        def fine(t: float) -> bool:
            nonlocal start, used
            if t >= start + 86400:
                start, used = t, 0
            used += 1
            return used <= 3

        return fine

    e = Tables(spark, d).events.select("user_id", "event_id", (F.unix_micros("ts") / 1e6).alias("t"))
    ok = scan_groups(e, "user_id", ["t", "event_id"], ["t"], judge).select("event_id", F.lit(True).alias("ok"))
    return e.join(ok, "event_id", "left").select("event_id", F.coalesce("ok", F.lit(False)).alias("allowed"))


@query("STR-12", """, f AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 12 HOURS THEN 1 ELSE 0 END AS new FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM f) SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM g GROUP BY user_id, s""")
def session_windows(spark: SparkSession, d: str) -> DataFrame:
    out = Tables(spark, d).events.groupBy(F.session_window("ts", "12 hours"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return out.select("user_id", F.date_format("session_window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


@query("UDF-1", "SELECT lang, count(*) AS n FROM documents WHERE n_chars > 1000 GROUP BY 1")
def transform_step(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).documents.transform(lambda df, least: df.where(F.col("n_chars") > least), 1000).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query("UDF-12", "SELECT channel_id, left(md5(project || '|' || channel_name), 8) AS h FROM channels")
def sql_function(spark: SparkSession, d: str) -> DataFrame:
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION short_key(a STRING, b STRING) RETURNS STRING RETURN left(md5(concat_ws('|', a, b)), 8)")
    return Tables(spark, d).channels.select("channel_id", F.expr("short_key(project, channel_name)").alias("h"))


UDF13 = ", r AS (SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY publish_date DESC, content_id) AS rn FROM content WHERE publish_date >= TIMESTAMP '2001-01-01') "


@query("UDF-13", UDF13 + "SELECT channel_id AS grp, content_id AS id, publish_date AS at, rn AS rank FROM r WHERE rn <= 2")
def table_function(spark: SparkSession, d: str) -> DataFrame:
    """The latest rows of each group by a table function over a partitioned, ordered table."""
    from loomcast.functions.tables import register_latest

    register_latest(spark)
    c = Tables(spark, d).content.select(F.col("channel_id").alias("grp"), F.col("content_id").alias("id"), F.col("publish_date").alias("at"))
    return spark.sql("SELECT * FROM latest_of(TABLE(SELECT * FROM {c} WHERE at >= TIMESTAMP '2001-01-01') PARTITION BY grp ORDER BY (at DESC, id), 2)", c=c)


@query("UDF-13-VIEW", UDF13 + "SELECT channel_id, content_id FROM r WHERE rn = 1")
def parameterised_view(spark: SparkSession, d: str) -> DataFrame:
    c = Tables(spark, d).content
    return spark.sql("SELECT channel_id, max_by(content_id, struct(publish_date, -content_id)) AS content_id FROM {c} WHERE publish_date >= cast(:since AS timestamp) GROUP BY channel_id", {"since": "2001-01-01"}, c=c)


@query("TOP-14", "SELECT label, round(quantile_cont(vec_id, 0.5), 4) AS median FROM vec GROUP BY 1")
def medians(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).vectors.groupBy("label").agg(F.round(F.percentile("vec_id", 0.5), 4).alias("median"))


#: Rows of the driver's events as a worker's outcomes: '' is a success.
OUTCOME_SQL = """, x AS (SELECT user_id, event_id, epoch_us(ts) // 1000 AS ms, CASE WHEN event_type <> 'error' THEN '' WHEN k >= 80 THEN 'auth' ELSE 'error' END AS kind,
  row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000, event_id) AS rn FROM ev), mark AS (SELECT max(ms) - 3600000 AS mark FROM x)
"""
OUTCOME = "CASE WHEN event_type <> 'error' THEN '' WHEN try_cast(get_json_object(props, '$.k') AS bigint) >= 80 THEN 'auth' ELSE 'error' END"


@query("STR-8", OUTCOME_SQL + """,
w(user_id, rn, ms, n, last, until, expired, cleared, paused) AS (
  SELECT user_id, rn, ms, CASE WHEN kind = '' THEN 0 ELSE 1 END, ms, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT FROM x WHERE rn = 1
  UNION ALL SELECT user_id, rn, ms, n, last, CASE WHEN kind = '' THEN 0 WHEN n >= 3 THEN ms + pause ELSE u END, expired, CASE WHEN kind = '' THEN u ELSE 0 END, CASE WHEN kind <> '' AND n >= 3 THEN ms + pause ELSE 0 END
  FROM (SELECT y.*, CASE WHEN kind = '' THEN 0 WHEN n0 > 0 AND ms - last0 > 604800000 THEN 1 ELSE n0 + 1 END AS n, CASE WHEN kind = '' THEN last0 ELSE ms END AS last
    FROM (SELECT x.user_id, x.rn, x.ms, x.kind, w.last AS last0, CASE x.kind WHEN 'auth' THEN 259200000 ELSE 21600000 END AS pause,
      CASE WHEN w.until > 0 AND x.ms >= w.until THEN 0 ELSE w.n END AS n0, CASE WHEN w.until > 0 AND x.ms >= w.until THEN 0 ELSE w.until END AS u,
      CASE WHEN w.until > 0 AND x.ms >= w.until THEN w.until ELSE 0 END AS expired FROM w JOIN x ON x.user_id = w.user_id AND x.rn = w.rn + 1) y)),
z AS (SELECT w.user_id, w.until FROM w JOIN (SELECT user_id, max(rn) AS rn FROM x GROUP BY 1) e USING (user_id, rn), mark WHERE w.until > 0 AND w.until <= mark)
SELECT user_id, 'paused' AS event, ms AS at_ms, paused AS until_ms FROM w WHERE paused > 0 UNION ALL SELECT user_id, 'resumed', expired, expired FROM w WHERE expired > 0
UNION ALL SELECT user_id, 'resumed', ms, cleared FROM w WHERE cleared > 0 UNION ALL SELECT user_id, 'resumed', until, until FROM z""")
def failure_pauses(spark: SparkSession, d: str) -> DataFrame:
    """Workers paused at the third failure in a row, for a time by its kind, and their return, over the events as a stream."""
    from loomcast.streaming import timed

    out = timed.failure_pauses(event_stream(spark, d), "user_id", "ts", "event_id", F.expr(OUTCOME), 3, 604800, {"error": 21600, "auth": 259200})
    return timed.run_timed(out, folder(spark))


@query("STR-6-STREAM", OUTCOME_SQL + """, l AS (SELECT *, ms + CASE kind WHEN 'auth' THEN 43200000 ELSE 172800000 END AS due FROM x), p AS (SELECT *, max(due) OVER (PARTITION BY user_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM l)
SELECT user_id, 'stale' AS event, before AS at_ms, ms AS until_ms FROM p WHERE ms >= before
UNION ALL SELECT user_id, 'stale', due, NULL FROM (SELECT user_id, max(due) AS due FROM l GROUP BY 1), mark WHERE due <= mark""")
def stale_workers(spark: SparkSession, d: str) -> DataFrame:
    """Workers that went stale, and when they were heard again, over the events as a stream."""
    from loomcast.streaming import timed

    out = timed.stale_heartbeats(event_stream(spark, d), "user_id", "ts", "event_id", F.expr(OUTCOME), {"": 172800, "auth": 43200})
    return timed.run_timed(out, folder(spark))


@query("STR-8-RUNS", """, f AS (SELECT user_id, ts, event_id, event_type = 'error' AS bad FROM ev), g AS (SELECT *, sum(CASE WHEN bad THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS grp FROM f)
SELECT user_id, max(c)::BIGINT AS longest FROM (SELECT user_id, grp, count(*) FILTER (bad) AS c FROM g GROUP BY 1, 2) GROUP BY 1""")
def failure_runs(spark: SparkSession, d: str) -> DataFrame:
    """The batch form of the failure tracker: each worker's longest run of failures."""
    e = Tables(spark, d).events.withColumn("bad", F.col("event_type") == "error")
    r = Wn.runs(e, ["user_id"], ["ts", "event_id"], "bad").groupBy("user_id", "run").agg(F.count_if("bad").alias("c"))
    return r.groupBy("user_id").agg(F.max("c").alias("longest"))


@query("UDF-2", "SELECT channel_id, round(CASE WHEN project = 'BUILDING' THEN 1.5 ELSE 1 END * ln(1 + greatest(score, 0)) / ln(101), 6) AS x FROM channels")
def preference_callback(spark: SparkSession, d: str) -> DataFrame:
    """A user's preference as a function of columns, applied to a built-in score."""
    from loomcast.functions.scores import log_popularity_fixed

    def prefer(project):
        return F.when(project == "BUILDING", 1.5).otherwise(1.0)

    return Tables(spark, d).channels.select("channel_id", F.round(prefer(F.col("project")) * log_popularity_fixed(F.col("score")), 6).alias("x"))


#: Which events give work of a kind, as conditions.
TASK_RULES = {"retry": "event_type = 'error' AND k > 50", "greet": "event_type = 'signup'", "thank": "event_type = 'purchase' AND k >= 10"}


@query("UDF-11", "SELECT event_id, CASE WHEN event_type = 'error' THEN 'retry' WHEN event_type = 'signup' THEN 'greet' ELSE 'thank' END AS task FROM ev WHERE (event_type = 'error' AND k > 50) OR event_type = 'signup' OR (event_type = 'purchase' AND k >= 10)")
def task_strategies(spark: SparkSession, d: str) -> DataFrame:
    wanted = F.array_compact(F.array(*[F.when(F.expr(rule), name) for name, rule in TASK_RULES.items()]))
    return Tables(spark, d).events.select("event_id", F.explode(wanted).alias("task"))
