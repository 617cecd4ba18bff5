"""FLT and SRC: scans and filters of the domain, bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.functions import predicates as P
from loomcast.functions import text as X
from loomcast.operators import joins as J
from loomcast.operators.reliable import shared_folder
from loomcast.operators.textindex import search_index, write_index
from loomcast.operators.windows import top, top_per_group
from loomcast.plans.registry import Tables, query

ORDERS_NOW, EVENTS_NOW = "2001-08-02 00:00:00", "2024-01-31 00:00:00"


@query("SRC-1", "SELECT s.segment_id, c.content_id, c.channel_id, c.platform, s.length FROM segments s JOIN content c USING (content_id) WHERE c.platform IN ('1-URGENT', '2-HIGH') AND c.publish_date >= TIMESTAMP '2000-01-01'")
def content_segments(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    kept = t.content.where(P.all_of(P.one_of("platform", ["1-URGENT", "2-HIGH"]), P.between("publish_date", "2000-01-01", None)))
    return t.segments.join(kept, "content_id").select("segment_id", "content_id", "channel_id", "platform", "length")


@query("SRC-2", "SELECT event_id, event_type FROM ev WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAYS")
def window_scan(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).events.where(P.within_days("ts", 7, EVENTS_NOW)).select("event_id", "event_type")


@query("SRC-3", "SELECT vec_id, len(e) AS dim FROM vec WHERE label = 3 AND e IS NOT NULL")
def vector_scan(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).vectors.where((F.col("label") == 3) & F.col("e").isNotNull()).select("vec_id", F.size("e").cast("long").alias("dim"))


IDS = "SELECT segment_id FROM segments WHERE content_id % 7 = 0 AND idx = 1"


@query("SRC-4", f"SELECT segment_id, start_time, length FROM segments WHERE segment_id IN ({IDS})")
def segments_by_ids(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    ids = t.segments.where("content_id % 7 = 0 AND idx = 1").select("segment_id")
    return J.semi(t.segments, ids, "segment_id").select("segment_id", "start_time", "length")


@query("SRC-5", "SELECT vec_id, round(list_sum(e), 4) AS total FROM vec WHERE vec_id IN (SELECT user_id FROM ev)")
def vectors_by_ids(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    found = J.semi(t.vectors, t.events.select(F.col("user_id").alias("vec_id")), "vec_id")
    return found.select("vec_id", F.round(F.aggregate("e", F.lit(0.0), lambda s, x: s + x), 4).alias("total"))


COMPOSITE = "c.platform IN ('1-URGENT', '5-LOW') AND c.state IN ('F', 'O') AND c.publish_date BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-12-31' AND s.end_time - s.start_time BETWEEN 10 AND 30"


@query("FLT-1", f"SELECT s.segment_id, c.channel_id FROM segments s JOIN content c USING (content_id) WHERE {COMPOSITE}")
def composite(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    c = P.all_of(P.one_of("platform", ["1-URGENT", "5-LOW"]), P.one_of("state", ["F", "O"]), P.between("publish_date", "1996-01-01", "1999-12-31"), P.one_of("channel_id", None))
    s = P.length_between("start_time", "end_time", 10, 30)
    return t.segments.where(s).join(t.content.where(c), "content_id").select("segment_id", "channel_id")


#: A project list for each content: its customer's segment and that of the next one.
PROJECTS_SQL = """, pj AS (
  SELECT c.content_id, c.publish_date, list_sort(list_distinct(list(h.project))) AS projects FROM content c JOIN channels h ON h.channel_id IN (c.channel_id, c.channel_id + 1) GROUP BY 1, 2
)"""


def with_projects(t: Tables) -> DataFrame:
    keys = t.content.select("content_id", "publish_date", F.explode(F.array("channel_id", F.col("channel_id") + 1)).alias("channel_id"))
    return keys.join(t.channels.select("channel_id", "project"), "channel_id").groupBy("content_id", "publish_date").agg(F.sort_array(F.collect_set("project")).alias("projects"))


@query("FLT-2", PROJECTS_SQL + "SELECT content_id FROM pj WHERE list_has_any(projects, ['BUILDING', 'MACHINERY'])")
def array_overlap(spark: SparkSession, d: str) -> DataFrame:
    return with_projects(Tables(spark, d)).where(P.overlaps("projects", ["BUILDING", "MACHINERY"])).select("content_id")


@query("FLT-3", PROJECTS_SQL + "SELECT content_id FROM pj WHERE list_contains(projects, 'AUTOMOBILE')")
def array_member(spark: SparkSession, d: str) -> DataFrame:
    return with_projects(Tables(spark, d)).where(P.contains("projects", "AUTOMOBILE")).select("content_id")


@query("FLT-4", PROJECTS_SQL + "SELECT count(*) AS n FROM pj WHERE list_contains(projects, 'AUTOMOBILE') OR list_contains(projects, 'FURNITURE')")
def array_any(spark: SparkSession, d: str) -> DataFrame:
    kept = with_projects(Tables(spark, d)).where(P.any_of(P.contains("projects", "AUTOMOBILE"), P.contains("projects", "FURNITURE")))
    return kept.agg(F.count(F.lit(1)).alias("n"))


@query("FLT-5", "SELECT doc_id, lang FROM documents WHERE lang IN ('de', 'fr') AND source IN ('src1', 'src2', 'src3')")
def in_lists(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).documents.where(P.all_of(P.one_of("lang", ["de", "fr"]), P.one_of("source", ["src1", "src2", "src3"]))).select("doc_id", "lang")


@query("FLT-6", "SELECT content_id FROM content WHERE publish_date BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1997-06-30'")
def date_range(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).content.where(P.between("publish_date", "1997-03-01", "1997-06-30")).select("content_id")


@query("FLT-7", "SELECT content_id FROM content WHERE publish_date >= TIMESTAMP '2001-08-02' - INTERVAL 90 DAYS")
def relative_window(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).content.where(P.within_days("publish_date", 90, ORDERS_NOW)).select("content_id")


@query("FLT-8", "SELECT event_id FROM ev WHERE ts >= DATE '2024-01-20' - 5 AND ts < DATE '2024-01-20' + 1")
def half_open_days(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).events.where(P.day_window("ts", 5, "2024-01-20 15:30:00")).select("event_id")


@query("FLT-9", "SELECT segment_id FROM segments WHERE end_time - start_time >= 45")
def length_range(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).segments.where(P.length_between("start_time", "end_time", 45, None)).select("segment_id")


@query("FLT-10", "SELECT count(*) AS n FROM vec WHERE e IS NOT NULL")
def with_vector(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).vectors.where(F.col("e").isNotNull()).agg(F.count(F.lit(1)).alias("n"))


@query("FLT-11", "SELECT doc_id FROM documents WHERE text ILIKE '%the%' AND text ILIKE '%th_t%'")
def contains_all(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).documents.where(P.must_contain("text", ["the", "th_t"])).select("doc_id")


@query("FLT-12", "SELECT doc_id FROM documents WHERE text ILIKE '%licen_e%' OR text ILIKE '%password%'")
def contains_any(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).documents.where(P.must_contain_any("text", ["licen_e", "password"])).select("doc_id")


@query("FLT-13", "SELECT event_id FROM ev WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 10 DAYS AND props ILIKE '%k%' AND (props ILIKE '%7%' OR props ILIKE '%9%')")
def built_conditions(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).events.where(P.text_conditions("ts", "props", 10, EVENTS_NOW, ["k"], ["7", "9"])).select("event_id")


@query("FLT-14", "SELECT event_id FROM ev WHERE TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) >= 75")
def json_at_least(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).events.where(P.json_number("props", "$.k") >= 75).select("event_id")


@query("FLT-15", """, j AS (SELECT doc_id, split_part(text, ' ', 1) AS a, split_part(text, ' ', 2) AS b FROM documents)
SELECT doc_id FROM j WHERE regexp_matches(a, '(?i)th') OR regexp_matches(b, '(?i)th')""")
def json_path_regex(spark: SparkSession, d: str) -> DataFrame:
    words = F.slice(F.split("text", " "), 1, 2)
    meta = F.to_json(F.struct(F.transform(words, lambda w: F.struct(w.alias("term"))).alias("keywords")))
    return Tables(spark, d).documents.select("doc_id", meta.alias("meta")).where(P.json_array_matches("meta", "keywords", "term", "th")).select("doc_id")


@query("FLT-16", "SELECT event_id FROM ev WHERE json_extract_string(props, '$.k') = '42'")
def json_contains(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).events.where(P.json_equals("props", "k", "42")).select("event_id")


@query("FLT-17", "SELECT event_type, count(*) AS n FROM ev WHERE list_contains(json_keys(props), 'k') GROUP BY 1")
def json_key(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).events.where(P.json_has_key("props", "k")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("FLT-18", "SELECT event_id FROM ev WHERE nullif(event_type, 'view') IS DISTINCT FROM 'click'")
def null_safe_differs(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).events.where(P.distinct_from(F.nullif(F.col("event_type"), F.lit("view")), F.lit("click"))).select("event_id")


@query("FLT-19", "SELECT content_id FROM content WHERE state = 'P'")
def optional_parameter(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).content.where(P.all_of(P.optional_equal("platform", None), P.optional_equal("state", "P"))).select("content_id")


POSTINGS = r""", w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS ws FROM documents), tot AS (SELECT count(*) AS docs, sum(len(ws))::DOUBLE AS words FROM w),
u AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS term, generate_subscripts(ws, 1) AS pos FROM w), df AS (SELECT term, count(DISTINCT doc_id) AS df FROM u GROUP BY 1),
po AS (SELECT q.query_id, q.terms, doc_id, n, term, pos FROM u JOIN (SELECT query_id, terms, unnest(terms) AS term FROM questions) q USING (term)),
tf AS (SELECT query_id, any_value(terms) AS terms, doc_id, term, any_value(n) AS n, count(*) AS tf FROM po GROUP BY query_id, doc_id, term),
wt AS (SELECT query_id, any_value(terms) AS terms, doc_id, count(*) AS k, sum(ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n * docs / words))) AS w FROM tf JOIN df USING (term), tot GROUP BY query_id, doc_id),
gap AS (SELECT query_id, doc_id, term <> lag(term) OVER o AS other, pos - lag(pos) OVER o AS g FROM po WINDOW o AS (PARTITION BY query_id, doc_id ORDER BY pos)),
cl AS (SELECT query_id, doc_id, coalesce(sum(1.0 / (g * g)) FILTER (other), 0)::DOUBLE AS c FROM gap GROUP BY ALL),
rk AS (SELECT query_id, terms, k, doc_id, round(w + c, 6) AS rank FROM wt JOIN cl USING (query_id, doc_id))
"""


def text_index(t: Tables) -> str:
    """Folder of a new index of all documents."""
    folder = shared_folder(t.spark, "textindex")
    write_index(t.documents, folder)
    return folder


@query("FLT-20", ", questions AS (SELECT 0 AS query_id, ['ention', 'heer', 'licensed'] AS terms)" + POSTINGS + "SELECT doc_id, rank FROM rk QUALIFY row_number() OVER (ORDER BY rank DESC, doc_id) <= 1000")
def full_text(spark: SparkSession, d: str) -> DataFrame:
    """The thousand best documents with any of the keywords."""
    asked = spark.sql("SELECT 0 AS query_id, array('ention', 'heer', 'licensed') AS terms")
    return search_index(spark, text_index(Tables(spark, d)), asked, limit=1000).select("doc_id", "rank")


@query("FLT-20-ALL", r", questions AS (SELECT item_id AS query_id, list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')[:3]) AS terms FROM benchmark)" + POSTINGS + "SELECT query_id, doc_id, rank FROM rk WHERE k = len(terms)")
def full_text_questions(spark: SparkSession, d: str) -> DataFrame:
    """Every document that has all of a question's terms; the questions are the openings of the benchmark's items."""
    t = Tables(spark, d)
    asked = t.raw("benchmark").select(F.col("item_id").alias("query_id"), F.slice(F.expr(r"regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+', 0)"), 1, 3).alias("terms"))
    return search_index(spark, text_index(t), asked, every=True)


@query("FLT-21", "SELECT strftime(publish_date, '%Y-%m') AS month, count(*) AS n FROM content WHERE strftime(publish_date, '%Y-%m') LIKE '1998%' GROUP BY 1")
def like_prefix(spark: SparkSession, d: str) -> DataFrame:
    c = Tables(spark, d).content.where(P.between("publish_date", "1998-01-01", "1998-12-31 23:59:59.999999"))  # reaches the scan, unlike a prefix of a formatted date
    return c.select(F.date_format("publish_date", "yyyy-MM").alias("month")).where(F.col("month").startswith("1998")).groupBy("month").agg(F.count(F.lit(1)).alias("n"))


@query("FLT-22", r"SELECT s_suppkey AS speaker_id FROM supplier WHERE regexp_matches(s_name, '^Supplier#\d+1$')")
def regex_label(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).raw("supplier").where(F.col("s_name").rlike(r"^Supplier#\d+1$")).select(F.col("s_suppkey").alias("speaker_id"))


@query("FLT-23", "SELECT min(channel_id) AS channel_id FROM channels WHERE lower(project) = lower('Building')")
def equal_ignoring_case(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).channels.where(P.equals_ignoring_case("project", "Building")).agg(F.min("channel_id").alias("channel_id"))


@query("FLT-24", "SELECT source, count(*) AS n FROM documents WHERE source = 'src1' GROUP BY 1")
def exact_else_contains(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the sources of the best level found: equal, else containing."""
    hits = Tables(spark, d).documents.where(F.col("source").ilike("%src1%")).groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    levels = hits.withColumn("level", F.when(F.col("source") == "src1", 0).otherwise(1))
    return levels.crossJoin(F.broadcast(levels.agg(F.min("level").alias("best")))).where("level = best").select("source", "n")


def group_window(start: str | None, end: str | None, filter_start: str | None, filter_end: str | None, days: int | None, as_of: str):
    """Condition on publish_date: explicit dates before the filter's before a relative window."""
    if start or end:
        return P.between("publish_date", start, end)
    if filter_start or filter_end:
        return P.between("publish_date", filter_start, filter_end)
    return P.within_days("publish_date", days, as_of)


@query("FLT-25", "SELECT count(*) AS n FROM content WHERE publish_date BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '1999-06-30'")
def dynamic_group(spark: SparkSession, d: str) -> DataFrame:
    kept = Tables(spark, d).content.where(group_window(None, None, "1999-01-01", "1999-06-30", 30, ORDERS_NOW))
    return kept.agg(F.count(F.lit(1)).alias("n"))


@query("FLT-26", "SELECT x AS channel_id FROM (VALUES (1), (-5), (2), (99999999)) v(x) WHERE x NOT IN (SELECT channel_id FROM channels)")
def missing_channels(spark: SparkSession, d: str) -> DataFrame:
    asked = spark.sql("SELECT cast(x AS bigint) AS channel_id FROM VALUES (1), (-5), (2), (99999999) AS v(x)")
    return J.anti(asked, Tables(spark, d).channels, "channel_id")


@query("FLT-28", """SELECT doc_id, CASE WHEN length(text) <= 200 THEN text ELSE
  (CASE WHEN strpos(reverse(substr(text, 1, 200)), ' ') > 0 AND 200 - strpos(reverse(substr(text, 1, 200)), ' ') > 140
        THEN substr(text, 1, 200 - strpos(reverse(substr(text, 1, 200)), ' ')) ELSE substr(text, 1, 200) END) || '...' END AS short FROM documents""")
def truncated(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).documents.select("doc_id", X.truncate_description(F.col("text")).alias("short"))


@query("FLT-29", """SELECT channel_id, CASE WHEN project = 'BUILDING' THEN 'https://i.ytimg.com/vi/' || regexp_replace(channel_name, '^yt_', '') || '/mqdefault.jpg'
  WHEN score > 0 THEN '/channel-images/' || channel_name END AS url FROM channels""")
def thumbnails(spark: SparkSession, d: str) -> DataFrame:
    platform = F.when(F.col("project") == "BUILDING", "youtube").otherwise("podcast")
    return Tables(spark, d).channels.select("channel_id", X.thumbnail_url(F.col("channel_name"), platform, F.col("channel_name"), F.col("score") > 0).alias("url"))


SORT_FIELDS = {"publish_date": "publish_date", "duration": "duration", "channel": "channel_id"}


def sort_field(name: str | None) -> str:
    """A column that may be sorted by; publish_date for any other name."""
    return SORT_FIELDS.get(name or "", "publish_date")


@query("FLT-30", "SELECT content_id, duration FROM content ORDER BY duration DESC, content_id LIMIT 50")
def sorted_by(spark: SparkSession, d: str) -> DataFrame:
    return top(Tables(spark, d).content, [F.col(sort_field("duration")).desc_nulls_last(), F.col("content_id")], 50).select("content_id", "duration")


def page(df: DataFrame, order: list, limit: int, offset: int, most: int = 5000) -> DataFrame:
    return top(df, order, min(limit, most), offset)


@query("FLT-31", "SELECT content_id FROM content ORDER BY publish_date DESC, content_id LIMIT 25 OFFSET 50")
def paged(spark: SparkSession, d: str) -> DataFrame:
    return page(Tables(spark, d).content, [F.col("publish_date").desc_nulls_last(), F.col("content_id")], 25, 50).select("content_id")


@query("FLT-32", "SELECT event_id, user_id, count(*) OVER () AS total FROM ev WHERE user_id = 7 AND event_type ILIKE '%c%' ORDER BY ts DESC, event_id LIMIT 10 OFFSET 5")
def bookmarks(spark: SparkSession, d: str) -> DataFrame:
    mine = Tables(spark, d).events.where((F.col("user_id") == 7) & F.col("event_type").ilike("%c%"))
    total = mine.agg(F.count(F.lit(1)).alias("total"))
    return page(mine, [F.col("ts").desc(), F.col("event_id")], 10, 5).select("event_id", "user_id").crossJoin(F.broadcast(total))


@query("FLT-33", PROJECTS_SQL + "SELECT content_id FROM pj WHERE len(list_filter(projects, lambda x: x NOT IN ('BUILDING', 'MACHINERY', 'FURNITURE'))) = 0")
def access(spark: SparkSession, d: str) -> DataFrame:
    allowed = F.array(*map(F.lit, ["BUILDING", "MACHINERY", "FURNITURE"]))
    return with_projects(Tables(spark, d)).where(P.access_allowed(F.col("projects"), allowed)).select("content_id")


LANGUAGES = {"english": "en", "french": "fr", "german": "de", "spanish": "es"}
PERIODS = {"today": 1, "this week": 7, "last week": 7, "this month": 30, "last month": 30, "this year": 365}


def parse_question(text: str, default_days: int = 7) -> dict:
    """Languages and a time window named in a question, by dictionary; the rest is the search text."""
    low = text.lower()
    days = next((n for words, n in PERIODS.items() if words in low), default_days)
    return {"languages": sorted({code for name, code in LANGUAGES.items() if name in low}) or None, "days": days, "query": text}


@query("FLT-27", "SELECT source, count(*) AS n FROM documents WHERE lang IN ('de', 'fr') GROUP BY 1")
def natural_language(spark: SparkSession, d: str) -> DataFrame:
    asked = parse_question("What did German and French channels say this week?")
    return Tables(spark, d).documents.where(P.all_of(P.one_of("lang", asked["languages"]))).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query("SRC-12", r"SELECT page_id, regexp_extract(html, '<h1>(.*?)</h1>', 1, 's') AS name, len(regexp_extract_all(html, '<li><a href=')) AS n_links FROM pages")
def chart_scrape(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).raw("pages").select(
        "page_id", F.regexp_extract("html", r"(?s)<h1>(.*?)</h1>", 1).alias("name"), F.size(F.regexp_extract_all("html", F.lit("<li><a href="), F.lit(0))).cast("long").alias("n_links")
    )


@query("SRC-17", """, asked AS (SELECT event_id, k AS doc_id, 'm' || (event_id % 2) AS model FROM ev WHERE event_type = 'view'), held AS (SELECT doc_id, md5(text) AS h, 'm1' AS model, source AS answer FROM documents WHERE doc_id % 3 <> 0)
SELECT event_id, answer FROM asked JOIN documents d USING (doc_id) LEFT JOIN held ON held.doc_id = d.doc_id AND held.h = md5(d.text) AND held.model = asked.model""")
def cached_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Answers cached by (segment, hash of its text, model); null where none is held."""
    t = Tables(spark, d)
    held = t.documents.where("doc_id % 3 <> 0").select("doc_id", F.md5("text").alias("text_hash"), F.lit("m1").alias("model"), F.col("source").alias("answer"))
    asked = t.events.where("event_type = 'view'").select("event_id", F.col("k").alias("doc_id"), F.concat(F.lit("m"), F.col("event_id") % 2).alias("model"))
    texts = t.documents.select("doc_id", F.md5("text").alias("text_hash"))
    return asked.join(texts, "doc_id").join(held, ["doc_id", "text_hash", "model"], "left").select("event_id", "answer")


@query("WIN-1", """, r AS (SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY publish_date DESC, content_id) AS rn FROM content)
SELECT channel_id, content_id FROM r WHERE rn = 1""")
def latest_per_channel(spark: SparkSession, d: str) -> DataFrame:
    return top_per_group(Tables(spark, d).content, ["channel_id"], [F.col("publish_date").desc_nulls_first(), F.col("content_id")]).select("channel_id", "content_id")
