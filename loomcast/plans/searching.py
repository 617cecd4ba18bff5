"""VEC and CLU: vector search, selection, clustering and graphs bound to the driver's tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.functions import predicates as P
from loomcast.functions import scores as S
from loomcast.functions import vectors as V
from loomcast.operators import ann as N
from loomcast.operators import cluster as C
from loomcast.operators import search as Q
from loomcast.operators.density import density_clusters
from loomcast.operators.features import agglomerative
from loomcast.operators.windows import top, top_per_group
from loomcast.plans.registry import Tables, query

QS = ", q AS (SELECT vec_id AS query_id, e AS qe FROM vec WHERE vec_id % 20 = 0), r AS (SELECT query_id, vec_id, label, round(list_cosine_similarity(e, qe), 6) AS sim FROM vec, q)\n"


def queries(t: Tables) -> DataFrame:
    return t.vectors.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("e").alias("qe"))


@query("VEC-1", QS + ", k AS (SELECT *, row_number() OVER (PARTITION BY query_id, label ORDER BY sim DESC, vec_id) AS rn FROM r), b AS (SELECT vec_id, max(sim) AS sim FROM k WHERE rn <= 5 AND sim >= 0.1 GROUP BY 1) SELECT vec_id, sim FROM b")
def per_project(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return Q.nearest(t.vectors, queries(t), 5, 0.1, keys=["label"]).groupBy("vec_id").agg(F.max("sim").alias("sim"))


@query("VEC-2", QS + ", k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id) AS rn FROM r) SELECT query_id, vec_id, sim FROM k WHERE rn <= 8")
def batch(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return Q.nearest(t.vectors, queries(t), 8).select("query_id", "vec_id", "sim")


@query("VEC-3", QS + ", k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id) AS rn FROM r) SELECT vec_id, max(sim) AS sim FROM k WHERE rn <= 50 AND sim >= 0.05 GROUP BY 1")
def unified(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return Q.search_best(t.vectors, queries(t), 50, 0.05)


@query("VEC-4", ", w AS (SELECT doc_id FROM documents WHERE text ILIKE '%the%' ORDER BY doc_id LIMIT 300), q AS (SELECT e AS qe FROM vec WHERE vec_id = 5) SELECT vec_id, round(list_cosine_similarity(e, qe), 6) AS sim FROM vec JOIN w ON w.doc_id = vec_id, q WHERE round(list_cosine_similarity(e, qe), 6) >= 0.05")
def keyword_then_semantic(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    words = top(t.documents.where(P.must_contain("text", ["the"])).select("doc_id"), [F.col("doc_id")], 300)
    one = t.vectors.where("vec_id = 5").select(F.lit(0).alias("query_id"), F.col("e").alias("qe"))
    return Q.scored(t.vectors.join(words.select(F.col("doc_id").alias("vec_id")), "vec_id", "left_semi"), one).where("sim >= 0.05").select("vec_id", "sim")


@query("VEC-5", ", q AS (SELECT e AS qe FROM vec WHERE vec_id = 9) SELECT vec_id, round(list_cosine_similarity(e, qe), 6) AS sim FROM vec, q WHERE label IN (1, 2, 3) AND round(list_cosine_similarity(e, qe), 6) > -0.2 ORDER BY sim DESC, vec_id LIMIT 10 OFFSET 5")
def filtered_page(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    one = t.vectors.where("vec_id = 9").select(F.lit(0).alias("query_id"), F.col("e").alias("qe"))
    hits = Q.scored(t.vectors.where(P.one_of("label", [1, 2, 3])), one).where("sim > -0.2").select("vec_id", "sim")
    return top(hits, [F.col("sim").desc(), F.col("vec_id")], 10, 5)


@query("VEC-6", ", q AS (SELECT e AS qe FROM vec WHERE vec_id = 9) SELECT vec_id, round(list_cosine_similarity(e, qe), 6) AS sim FROM vec, q WHERE label = 4 ORDER BY sim DESC, vec_id LIMIT 12")
def filter_first(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    one = t.vectors.where("vec_id = 9").select(F.lit(0).alias("query_id"), F.col("e").alias("qe"))
    return Q.search(t.vectors.where("label = 4"), one, 12).select("vec_id", "sim")


@query("VEC-7", ", q AS (SELECT e AS qe FROM vec WHERE vec_id = 2) SELECT vec_id, d.lang, round(list_cosine_similarity(e, qe), 6) AS sim FROM vec JOIN documents d ON d.doc_id = vec_id, q WHERE d.lang IN ('fr') ORDER BY sim DESC, vec_id LIMIT 10")
def natural_retrieve(spark: SparkSession, d: str) -> DataFrame:
    from loomcast.plans.filters import parse_question

    t = Tables(spark, d)
    asked = parse_question("french voices this week")
    kept = t.vectors.join(t.documents.where(P.one_of("lang", asked["languages"])).select(F.col("doc_id").alias("vec_id"), "lang"), "vec_id")
    return Q.search(kept, t.vectors.where("vec_id = 2").select(F.lit(0).alias("query_id"), F.col("e").alias("qe")), 10).select("vec_id", "lang", "sim")


@query("VEC-8", QS + ", m AS (SELECT vec_id, query_id % 300 AS sub, max(sim) AS s FROM r GROUP BY 1, 2) SELECT vec_id, array_to_string(list_sort(list(sub)), ',') AS subthemes, max(s) AS best FROM m WHERE s >= 0.1 GROUP BY 1")
def bilingual(spark: SparkSession, d: str) -> DataFrame:
    """Queries stand for (subtheme, language) pairs: a segment's score for a subtheme is its best over languages."""
    t = Tables(spark, d)
    asked = queries(t).select("qe", "query_id", (F.col("query_id") % 300).alias("sub"))
    found = Q.tiled(t.vectors.select("vec_id", "e"), asked, Q.best_queries(0.1, "sub"), "vec_id", "e", "query_id", "qe", "s", part=F.col("sub"))
    best = found.select("vec_id", "sub", "s")
    return best.groupBy("vec_id").agg(F.array_join(F.sort_array(F.collect_set("sub")).cast("array<string>"), ",").alias("subthemes"), F.max("s").alias("best"))


@query("VEC-9", QS + ", kw AS (SELECT doc_id AS vec_id FROM documents WHERE text ILIKE '%ing%'), m AS (SELECT vec_id, max(sim) AS s FROM r GROUP BY 1) SELECT m.vec_id, CASE WHEN s >= 0.2 AND kw.vec_id IS NOT NULL THEN 'both' WHEN s >= 0.2 THEN 'semantic' ELSE 'keyword' END AS via FROM m LEFT JOIN kw USING (vec_id) WHERE s >= 0.2 OR (kw.vec_id IS NOT NULL AND s >= 0.1)")
def relaxed_union(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    found = Q.tiled(t.vectors.select("vec_id", "e"), queries(t), Q.best_queries(0.1), "vec_id", "e", "query_id", "qe", "s")
    best = found.groupBy("vec_id").agg(F.max("s").alias("s"))
    words = t.documents.where(P.must_contain("text", ["ing"])).select(F.col("doc_id").alias("vec_id"), F.lit(True).alias("kw"))
    both = best.join(words, "vec_id", "left").withColumn("kw", F.coalesce("kw", F.lit(False)))
    via = F.when((F.col("s") >= 0.2) & F.col("kw"), "both").when(F.col("s") >= 0.2, "semantic").otherwise("keyword")
    return both.where("s >= 0.2 OR (kw AND s >= 0.1)").select("vec_id", via.alias("via"))


@query("VEC-10", ", q AS (SELECT e AS qe FROM vec WHERE vec_id = 11) SELECT vec_id, round(list_cosine_similarity(e, qe), 6) AS sim FROM vec, q WHERE vec_id <> 11 AND round(list_cosine_similarity(e, qe), 6) > 0.1 ORDER BY sim DESC, vec_id LIMIT 7")
def similar_speakers(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    hits = Q.scored(t.vectors.where("vec_id <> 11"), t.vectors.where("vec_id = 11").select(F.lit(0).alias("query_id"), F.col("e").alias("qe"))).where("sim > 0.1").select("vec_id", "sim")
    return top(hits, [F.col("sim").desc(), F.col("vec_id")], 7)


@query("VEC-11", QS + ", x AS (SELECT * FROM r WHERE query_id <> vec_id AND sim >= CASE WHEN vec_id % 4 = 0 THEN greatest(0.05, 0.15 - 0.05) ELSE 0.15 END), k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id) AS rn FROM x) SELECT query_id, vec_id, sim FROM k WHERE rn <= 5")
def quality_threshold(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)

    def least(rows):
        return np.where(rows.column("vec_id").to_numpy() % 4 == 0, max(0.05, 0.15 - 0.05), 0.15)

    return Q.nearest(t.vectors, queries(t), 5, least=least, apart=True).select("query_id", "vec_id", "sim")


@query("VEC-12", """, q AS (SELECT e AS qe FROM vec WHERE vec_id = 4), h AS (SELECT vec_id, vec_id % 40 AS episode, label, round(list_cosine_similarity(e, qe), 6) AS sim FROM vec, q),
s AS (SELECT *, round((0.4 * sim + 0.2 * (vec_id % 7) / 7 + 0.2 * exp(-0.15 * (vec_id % 30))) / 0.8, 6) AS final_score FROM h WHERE sim >= 0),
e1 AS (SELECT *, row_number() OVER (PARTITION BY episode ORDER BY final_score DESC, vec_id) AS rn FROM s), c1 AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY final_score DESC, vec_id) AS rc FROM e1 WHERE rn = 1)
SELECT vec_id, final_score FROM c1 WHERE rc <= 3""")
def reranked(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    hits = Q.scored(t.vectors.withColumn("episode", F.col("vec_id") % 40), t.vectors.where("vec_id = 4").select(F.lit(0).alias("query_id"), F.col("e").alias("qe")))
    signals = {"similarity": F.col("sim"), "popularity": F.col("vec_id") % 7 / 7, "recency": S.exponential_decay(F.col("vec_id") % 30)}
    out = Q.rerank(hits, signals, {"similarity": 0.4, "popularity": 0.2, "recency": 0.2}, 0.0, episode="episode", channel="label", per_channel=3, row_id="vec_id")
    return out.select("vec_id", "final_score")


def greedy_sql(base: str, n: int, weight: float, small_whole: bool = True) -> str:
    """The greedy choice of n rows a group, a table for each place; base gives (g, vec_id, static, e)."""
    out = f", base AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY g) AS size FROM ({base})), s0 AS MATERIALIZED (SELECT g, vec_id, static, e, NULL::DOUBLE AS near FROM base WHERE e IS NOT NULL{f' AND size > {n}' if small_whole else ''})\n"
    for i in range(1, n + 1):
        gain = f"coalesce({weight} * (1 - near), 0) + static"
        out += f", p{i} AS MATERIALIZED (SELECT g, arg_min(vec_id, (-({gain}), -static, vec_id)) AS vec_id FROM s{i - 1} GROUP BY 1), c{i} AS MATERIALIZED (SELECT p.g, p.vec_id, s.e FROM p{i} p JOIN s{i - 1} s ON s.g = p.g AND s.vec_id = p.vec_id)\n"
        out += f", s{i} AS MATERIALIZED (SELECT s.g, s.vec_id, s.static, s.e, greatest(s.near, list_dot_product(s.e, c.e)) AS near FROM s{i - 1} s JOIN c{i} c ON c.g = s.g AND c.vec_id <> s.vec_id)\n"
    picks = " UNION ALL ".join(f"SELECT g, vec_id, {i} AS picked FROM c{i}" for i in range(1, n + 1))
    small = f" UNION ALL SELECT g, vec_id, row_number() OVER (PARTITION BY g ORDER BY static DESC, vec_id) FROM base WHERE size <= {n}" if small_whole else ""
    return out + f", picks AS ({picks}{small}) "


def candidates(t: Tables) -> DataFrame:
    return t.vectors.select("vec_id", "label", "e", (F.col("vec_id") % 11 / 11).alias("static"))


@query("VEC-13", greedy_sql("SELECT 0 AS g, vec_id, vec_id % 11 / 11 AS static, e FROM vec", 20, 0.5) + "SELECT vec_id, picked FROM picks")
def diverse(spark: SparkSession, d: str) -> DataFrame:
    return Q.diverse(candidates(Tables(spark, d)), "static", "e", "vec_id", 20, 0.5).select("vec_id", "picked")


@query("VEC-14", "SELECT vec_id, round(vec_id % 11 / 11, 6) AS static FROM vec ORDER BY vec_id % 11 DESC, vec_id LIMIT 20")
def rank_only(spark: SparkSession, d: str) -> DataFrame:
    return Q.select_top(candidates(Tables(spark, d)), "static", "vec_id", 20).select("vec_id", F.round("static", 6).alias("static"))


@query("VEC-15", greedy_sql("SELECT label AS g, vec_id, vec_id % 11 / 11 AS static, e FROM vec", 5, 0.5) + "SELECT g AS label, vec_id, picked FROM picks")
def balanced(spark: SparkSession, d: str) -> DataFrame:
    return Q.diverse(candidates(Tables(spark, d)), "static", "e", "vec_id", 5, 0.5, keys=["label"]).select("label", "vec_id", "picked")


@query("VEC-16", QS + ", k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id) AS rn FROM r WHERE vec_id % 2 = 1) SELECT q.query_id, k.vec_id AS hit, k.sim FROM q LEFT JOIN k ON k.query_id = q.query_id AND rn = 1 AND k.sim >= 0.3")
def semantic_cache(spark: SparkSession, d: str) -> DataFrame:
    """The nearest cached row (odd ids) of each query if it is near enough, else none."""
    t = Tables(spark, d)
    q = queries(t)
    hit = Q.nearest(t.vectors.where("vec_id % 2 = 1"), q, 1, 0.3).select("query_id", F.col("vec_id").alias("hit"), "sim")
    return q.select("query_id").join(hit, "query_id", "left")


@query("VEC-17", greedy_sql("SELECT label AS g, vec_id, 0.0::DOUBLE AS static, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM vec", 5, 1.0, False) + "SELECT g AS label, vec_id, picked FROM picks")
def farthest(spark: SparkSession, d: str) -> DataFrame:
    return Q.farthest_points(Tables(spark, d).vectors, "e", "vec_id", 5, ["label"]).select("label", "vec_id", "picked")


@query("VEC-1-ANN")
def indexed(spark: SparkSession, d: str) -> DataFrame:
    """VEC-1's search over an inverted-file index: ten nearest rows of each query, recall of 0.9 and more against the exact search."""
    t = Tables(spark, d)
    cells = N.fit_cells(t.vectors)
    return N.search(N.build(t.vectors, cells), queries(t), cells, 10, visit=32).select("query_id", F.col("id").alias("vec_id"), "sim")


@query("CLU-1")
def density_themes(spark: SparkSession, d: str) -> DataFrame:
    """The density cluster of every vector, -1 for noise."""
    return density_clusters(Tables(spark, d).vectors)


@query("CLU-1-WARD")
def agglomerative_themes(spark: SparkSession, d: str) -> DataFrame:
    """Eight clusters of all vectors by Ward linkage of their cells' features."""
    return agglomerative(Tables(spark, d).vectors, 8)


@query("CLU-1-KMEANS")
def themes(spark: SparkSession, d: str) -> DataFrame:
    out, _ = C.k_means(Tables(spark, d).vectors, [5], components=8)
    return out.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@query("CLU-2")
def forced_split(spark: SparkSession, d: str) -> DataFrame:
    out, report = C.k_means(Tables(spark, d).vectors, [2, 3, 4])
    return out.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).withColumn("k", F.lit(report["k"]))


@query("CLU-3", QS + "SELECT query_id, count(*) AS n FROM r WHERE sim >= 0.15 GROUP BY 1 HAVING count(*) >= 3")
def query_themes(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    count = Q.tiled(t.vectors.select("vec_id", "e"), queries(t), Q.count_rows(0.15), "vec_id", "e", "query_id", "qe", "n")
    return count.groupBy("query_id").agg(F.sum("n").cast("long").alias("n")).where("n >= 3")


@query("CLU-4", "SELECT w AS keyword, count(*) AS n FROM documents, (VALUES ('the'), ('que'), ('licensed'), ('zebra')) v(w) WHERE contains(lower(text), w) GROUP BY 1 HAVING count(*) >= 3")
def keyword_themes(spark: SparkSession, d: str) -> DataFrame:
    low = F.lower("text")
    hits = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(w)), w) for w in ("the", "que", "licensed", "zebra")]))
    return Tables(spark, d).documents.select(F.explode(hits).alias("keyword")).groupBy("keyword").agg(F.count(F.lit(1)).alias("n")).where("n >= 3")


@query("CLU-5")
def aligned(spark: SparkSession, d: str) -> DataFrame:
    v = Tables(spark, d).vectors.withColumn("grp", F.col("vec_id") % 3)
    return C.align(V.mean_vectors(v, ["grp", "label"]).withColumnRenamed("label", "theme"), 0.3)


@query("CLU-6")
def subthemes(spark: SparkSession, d: str) -> DataFrame:
    """The labels are themes, few by their nature; each is split by itself."""
    v, parts = Tables(spark, d).vectors, None
    for (label,) in v.where("label IS NOT NULL").select("label").distinct().orderBy("label").collect():
        out, report = C.k_means(v.where(F.col("label") == label), [2, 3])
        part = out.groupBy("label", "cluster").agg(F.count(F.lit(1)).alias("n"))
        parts = part if parts is None else parts.unionByName(part)
    return parts


MEANS = """, c AS (SELECT label, i, avg(e[i]) AS m FROM vec, range(1, 65) r(i) GROUP BY 1, 2), cm AS (SELECT label, list(m ORDER BY i) AS m FROM c GROUP BY 1),
dd AS (SELECT label, vec_id, list_distance(e, m) AS dist FROM vec JOIN cm USING (label)), st AS (SELECT label, avg(dist) AS s, count(*) AS n, sum(dist * dist) AS w FROM dd GROUP BY 1)
"""


@query("CLU-7", MEANS + """, pr AS (SELECT a.label, max((x.s + y.s) / list_distance(a.m, b.m)) AS r FROM cm a JOIN cm b ON a.label <> b.label JOIN st x ON x.label = a.label JOIN st y ON y.label = b.label GROUP BY 1),
gm AS (SELECT list(m ORDER BY i) AS g FROM (SELECT i, avg(e[i]) AS m FROM vec, range(1, 65) r(i) GROUP BY 1)), bt AS (SELECT sum(n * pow(list_distance(m, g), 2)) AS b, sum(w) AS w, sum(n) AS n, count(*) AS k FROM st JOIN cm USING (label), gm)
SELECT (SELECT round(avg(r), 5) FROM pr) AS davies_bouldin, round((b / (k - 1)) / (w / (n - k)), 5) AS calinski_harabasz FROM bt""")
def validated(spark: SparkSession, d: str) -> DataFrame:
    out = C.validation(Tables(spark, d).vectors, "label")
    return out.select(*[F.round(c, 5).alias(c) for c in out.columns])


@query("CLU-8")
def fast_clusters(spark: SparkSession, d: str) -> DataFrame:
    out, _ = C.k_means(Tables(spark, d).vectors, [4], components=32, least_size=10)
    return out.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@query("CLU-9")
def automatic_k(spark: SparkSession, d: str) -> DataFrame:
    _, report = C.k_means(Tables(spark, d).vectors, range(2, 6), components=8, least_size=10)
    return spark.sql(f"SELECT {report['k']} AS k, cast({report['silhouette'] or 0.0} AS double) AS silhouette")


@query("CLU-10", ", l AS (SELECT label FROM vec WHERE vec_id % 10 <> 0 GROUP BY 1 ORDER BY count(*) DESC, label LIMIT 1) SELECT vec_id, CASE WHEN vec_id % 10 = 0 THEN (SELECT label FROM l) ELSE label END AS grp FROM vec")
def largest_takes_rest(spark: SparkSession, d: str) -> DataFrame:
    v = Tables(spark, d).vectors.withColumn("cluster", F.when(F.col("vec_id") % 10 != 0, F.col("label")))
    largest = top(v.where("cluster IS NOT NULL").groupBy("cluster").agg(F.count(F.lit(1)).alias("n")), [F.col("n").desc(), F.col("cluster")], 1).select(F.col("cluster").alias("most"))
    return v.crossJoin(F.broadcast(largest)).select("vec_id", F.coalesce("cluster", "most").alias("grp"))


@query("CLU-11", """, sv AS (SELECT source, e FROM documents JOIN vec ON vec_id = doc_id), sc AS (SELECT source, i, avg(e[i]) AS m FROM sv, range(1, 65) r(i) GROUP BY 1, 2), sm AS (SELECT source, list(m ORDER BY i) AS m FROM sc GROUP BY 1),
co AS (SELECT source, avg(list_cosine_similarity(e, m)) AS c FROM sv JOIN sm USING (source) GROUP BY 1),
g AS (SELECT source, least(1, count(DISTINCT lang) / 4) AS b, least(1, count(*) / 50) AS i, avg(exp(-(doc_id % 30) / 7.0)) AS r FROM documents GROUP BY 1)
SELECT source, b AS breadth, round(i, 6) AS intensity, round(coalesce(c, 0), 6) AS coherence, round(r, 6) AS recency, round(0.35 * b + 0.25 * i + 0.25 * coalesce(c, 0) + 0.15 * r, 6) AS score FROM g LEFT JOIN co USING (source)""")
def topic_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Breadth, intensity, coherence (mean similarity to the topic's mean vector) and recency of each source as a topic."""
    t = Tables(spark, d)
    g = t.documents.groupBy("source").agg(F.count_distinct("lang").alias("l"), F.count(F.lit(1)).alias("n"), F.avg(F.exp(-(F.col("doc_id") % 30) / 7.0)).alias("r"))
    v = t.vectors.join(t.documents.select(F.col("doc_id").alias("vec_id"), "source"), "vec_id")
    close = v.join(V.mean_vectors(v, ["source"]).withColumnRenamed("e", "m"), "source").groupBy("source").agg(F.avg(V.cosine(F.col("e"), F.col("m"), 0.0)).alias("c"))
    breadth, intensity, coherence = F.least(F.lit(1.0), F.col("l") / 4), F.least(F.lit(1.0), F.col("n") / 50), F.coalesce("c", F.lit(0.0))
    score = 0.35 * breadth + 0.25 * intensity + 0.25 * coherence + 0.15 * F.col("r")
    return g.join(close, "source", "left").select("source", breadth.alias("breadth"), F.round(intensity, 6).alias("intensity"), F.round(coherence, 6).alias("coherence"), F.round("r", 6).alias("recency"), F.round(score, 6).alias("score"))


@query("CLU-12")
def cross_lingual(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    v = t.vectors.join(t.documents.select(F.col("doc_id").alias("vec_id"), F.col("lang").alias("grp")), "vec_id")
    return C.align(V.mean_vectors(v, ["grp", "label"]).withColumnRenamed("label", "theme"), 0.2)


KEYWORDS = r""", w AS (SELECT v.label, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS term FROM documents JOIN vec v ON doc_id = vec_id WHERE label IS NOT NULL),
tc AS (SELECT label, term, count(*) AS n FROM w GROUP BY ALL), sz AS (SELECT label, sum(n) AS size FROM tc GROUP BY 1), tf AS (SELECT term, sum(n) AS f FROM tc GROUP BY 1),
kw AS (SELECT label, term, round(n / size * ln(1 + (SELECT avg(size) FROM sz) / f), 6) AS weight FROM tc JOIN sz USING (label) JOIN tf USING (term)),
kr AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY weight DESC, term) AS rank FROM kw)
"""


def topic_texts(t: Tables) -> DataFrame:
    """A topic's texts: the documents of its vectors' ids."""
    return t.documents.join(t.vectors.select(F.col("vec_id").alias("doc_id"), "label"), "doc_id").select("label", "text")


@query("CLU-13", MEANS + KEYWORDS + """, nr AS (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY round(dist, 9), vec_id) AS rn FROM dd)
SELECT label, n, round(s, 6) AS mean_dist, (SELECT array_to_string(list_transform(m, lambda x: round(x * 1000)::BIGINT), ',') FROM cm WHERE cm.label = st.label) AS centroid,
  (SELECT string_agg(vec_id::VARCHAR, ',' ORDER BY rn) FROM nr WHERE nr.label = st.label AND rn <= 10) AS representatives, (SELECT string_agg(term, ',' ORDER BY rank) FROM kr WHERE kr.label = st.label AND rank <= 10) AS keywords FROM st""")
def cluster_metadata(spark: SparkSession, d: str) -> DataFrame:
    """A row for each cluster: size, mean distance, centroid in thousandths, nearest rows and keywords."""
    t = Tables(spark, d)
    words = C.topic_keywords(topic_texts(t), "label", "text").groupBy("label").agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("k"))
    out = C.cluster_metadata(t.vectors, "label").join(words, "label", "left")
    listed = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return out.select("label", "n", F.round("mean_dist", 6).alias("mean_dist"), listed(F.transform("centroid", lambda x: F.round(x * 1000).cast("long"))).alias("centroid"), listed(F.col("representatives")).alias("representatives"), listed(F.col("k.term")).alias("keywords"))


@query("CLU-13-KEYWORDS", MEANS + KEYWORDS + "SELECT label, rank, term, weight FROM kr WHERE rank <= 20")
def keywords(spark: SparkSession, d: str) -> DataFrame:
    return C.topic_keywords(topic_texts(Tables(spark, d)), "label", "text", most=20)


@query("CLU-13-NEAREST", MEANS + ", k AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY round(dist, 9), vec_id) AS rn FROM dd) SELECT label, vec_id, round(dist, 6) AS dist FROM k WHERE rn <= 3")
def cluster_nearest(spark: SparkSession, d: str) -> DataFrame:
    v = Tables(spark, d).vectors
    far = v.join(V.mean_vectors(v, ["label"]).withColumnRenamed("e", "m"), "label").select("label", "vec_id", V.euclidean(F.col("e"), F.col("m")).alias("x"))
    return top_per_group(far, ["label"], [F.round("x", 9), F.col("vec_id")], 3).select("label", "vec_id", F.round("x", 6).alias("dist"))


@query("CLU-14", ", m AS (SELECT max(strftime(ts, '%Y-%m-%d')) AS day FROM ev) SELECT event_type AS cluster, count(*) AS n, array_to_string(list(event_id ORDER BY value DESC, event_id), ',') AS ids FROM ev, m WHERE strftime(ts, '%Y-%m-%d') = day GROUP BY 1")
def latest_clusters(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events
    last = e.agg(F.date_trunc("day", F.max("ts")).alias("from"))
    run = e.join(F.broadcast(last), F.col("ts") >= F.col("from")).groupBy(F.col("event_type").alias("cluster"))
    held = run.agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct((-F.col("value")).alias("v"), "event_id"))).alias("h"))
    return held.select("cluster", "n", F.array_join(F.transform("h", lambda x: x["event_id"].cast("string")), ",").alias("ids"))


EDGES = ", p AS (SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.e, b.e), 6) AS sim FROM vec a JOIN vec b ON a.label = b.label AND a.vec_id <> b.vec_id), kn AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY sim DESC, b) AS rn FROM p WHERE sim >= 0.25), ed AS (SELECT a, b, sim FROM kn WHERE rn <= 5)\n"


def edges(t: Tables) -> DataFrame:
    return C.neighbours(t.vectors, 5, 0.25, block="label")


@query("CLU-15", EDGES + "SELECT a, b, sim FROM ed")
def knn_graph(spark: SparkSession, d: str) -> DataFrame:
    return edges(Tables(spark, d))


VOTES = EDGES + """, lb AS (SELECT vec_id AS b, 'L' || (vec_id % 4) AS label FROM vec WHERE vec_id % 3 = 0),
v AS (SELECT a, lb.label, sum(sim * sim) * CASE WHEN lb.label = 'L' || (a % 5) THEN 1.1 ELSE 1 END AS votes FROM ed JOIN lb USING (b) GROUP BY 1, 2),
o AS (SELECT *, row_number() OVER w AS rn, lead(votes) OVER w AS second FROM v WHERE a NOT IN (SELECT b FROM lb) WINDOW w AS (PARTITION BY a ORDER BY votes DESC, label))
"""


def votes(t: Tables) -> DataFrame:
    known = t.vectors.where("vec_id % 3 = 0").select(F.col("vec_id").alias("b"), F.concat(F.lit("L"), F.col("vec_id") % 4).alias("label"))
    named = t.vectors.select(F.col("vec_id").alias("a"), F.concat(F.lit("l"), F.col("vec_id") % 5).alias("label"))  # names of an episode's metadata
    return C.propagate(edges(t), known, 0.08, named=named)


@query("CLU-16", VOTES + "SELECT a, label, round(votes, 6) AS votes FROM o WHERE rn = 1 AND votes >= 0.08")
def propagated(spark: SparkSession, d: str) -> DataFrame:
    return votes(Tables(spark, d)).where("status <> 'weak'").select("a", "label", F.round("votes", 6).alias("votes"))


@query("CLU-17", MEANS + ", x AS (SELECT vec_id, cm.label, round(list_cosine_similarity(e, m), 6) AS sim FROM vec JOIN cm ON cm.label IN (vec.label, (vec.label + 1) % 10)), b AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, label) AS rn FROM x WHERE sim >= 0.2) SELECT vec_id, label, sim FROM b WHERE rn = 1")
def named_centroid(spark: SparkSession, d: str) -> DataFrame:
    v = Tables(spark, d).vectors
    named = v.select("vec_id", "e", F.explode(F.array("label", (F.col("label") + 1) % 10)).alias("label"))
    scored = named.join(V.mean_vectors(v, ["label"]).withColumnRenamed("e", "m"), "label").select("vec_id", "label", F.round(V.cosine(F.col("e"), F.col("m"), 0.0), 6).alias("sim")).where("sim >= 0.2")
    return top_per_group(scored, ["vec_id"], [F.col("sim").desc(), F.col("label")]).select("vec_id", "label", "sim")


@query("CLU-18", VOTES + "SELECT a, CASE WHEN votes < 0.08 THEN 'weak' WHEN coalesce(second / votes, 0) >= 0.7 THEN 'contested' ELSE 'assigned' END AS status FROM o WHERE rn = 1")
def contested(spark: SparkSession, d: str) -> DataFrame:
    return votes(Tables(spark, d)).select("a", "status")


CC = EDGES + """, sy AS (SELECT a, b FROM ed UNION SELECT b, a FROM ed), rc(node, c) AS (SELECT DISTINCT a, a FROM sy UNION SELECT sy.b, rc.c FROM rc JOIN sy ON sy.a = rc.node WHERE rc.c < sy.b),
co AS (SELECT node, min(c) AS component FROM rc GROUP BY 1)
"""


@query("CLU-20", CC + "SELECT node, component FROM co")
def components(spark: SparkSession, d: str) -> DataFrame:
    return C.connected_components(edges(Tables(spark, d)))


@query("CLU-21", CC + "SELECT v.label, count(DISTINCT component) AS groups FROM co JOIN vec v ON v.vec_id = co.node GROUP BY 1 HAVING count(*) < 500")
def name_collisions(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    found = C.connected_components(edges(t)).join(t.vectors.select(F.col("vec_id").alias("node"), "label"), "node")
    return found.groupBy("label").agg(F.count_distinct("component").alias("groups"), F.count(F.lit(1)).alias("n")).where("n < 500").drop("n")


@query("CLU-22")
def dense_cores(spark: SparkSession, d: str) -> DataFrame:
    return C.dense_core(Tables(spark, d).vectors, "label", "vec_id", "e", 0.05).select("label", "vec_id")


@query("CLU-25", CC + "SELECT component, count(*) AS n FROM co WHERE node % 2 = 1 GROUP BY 1 HAVING count(*) >= 3")
def unnamed(spark: SparkSession, d: str) -> DataFrame:
    return C.connected_components(edges(Tables(spark, d))).where("node % 2 = 1").groupBy("component").agg(F.count(F.lit(1)).alias("n")).where("n >= 3")


@query("CLU-26", "SELECT label, arg_max(vec_id, ((vec_id % 13) / 13.0 * 100 + least((vec_id % 90) / 60.0, 10) + 20, -vec_id)) AS anchor FROM vec GROUP BY 1")
def anchors(spark: SparkSession, d: str) -> DataFrame:
    score = F.col("vec_id") % 13 / 13.0 * 100 + F.least(F.col("vec_id") % 90 / 60.0, F.lit(10.0)) + 20
    return Tables(spark, d).vectors.groupBy("label").agg(F.max_by("vec_id", F.struct(score, -F.col("vec_id"))).alias("anchor"))


@query("CLU-27", """, t AS (SELECT *, 1 + vec_id % 13 AS w, row_number() OVER (PARTITION BY label ORDER BY vec_id % 13 DESC, vec_id) AS rn FROM vec), m AS (SELECT label, i, sum(e[i] * w) / sum(w) AS x FROM t, range(1, 65) r(i) WHERE rn <= 10 GROUP BY 1, 2), n AS (SELECT label, sqrt(sum(x * x)) AS n FROM m GROUP BY 1)
SELECT label, i, round(x / n, 6) AS x FROM m JOIN n USING (label)""")
def quality_centroid(spark: SparkSession, d: str) -> DataFrame:
    v = Tables(spark, d).vectors.withColumn("w", 1 + F.col("vec_id") % 13)
    return C.centroids(v, "label", weight="w", best=10).select("label", F.posexplode("e").alias("i", "x")).select("label", (F.col("i") + 1).cast("long").alias("i"), F.round("x", 6).alias("x"))


@query("CLU-28", EDGES + "SELECT DISTINCT least(a, b) AS x, greatest(a, b) AS y FROM ed WHERE sim >= 0.3")
def merge_candidates(spark: SparkSession, d: str) -> DataFrame:
    return edges(Tables(spark, d)).where("sim >= 0.3").select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct()


@query("CLU-30", EDGES + """, ok AS (SELECT a, b FROM ed WHERE a % 40 <> b % 40), sy AS (SELECT a, b FROM ok UNION SELECT b, a FROM ok), rc(node, c) AS (SELECT DISTINCT a, a FROM sy UNION SELECT sy.b, rc.c FROM rc JOIN sy ON sy.a = rc.node WHERE rc.c < sy.b),
co AS (SELECT node, min(c) AS component FROM rc GROUP BY 1) SELECT component, count(*) AS n, count(DISTINCT node % 40) AS episodes FROM co GROUP BY 1 HAVING count(*) >= 5""")
def constrained(spark: SparkSession, d: str) -> DataFrame:
    found = C.connected_components(edges(Tables(spark, d)).where("a % 40 <> b % 40"))
    return found.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.col("node") % 40).alias("episodes")).where("n >= 5")


@query("CLU-19", EDGES + ", lb AS (SELECT vec_id, 'L' || (vec_id % 4) AS name FROM vec) SELECT DISTINCT least(x.name, y.name) AS a, greatest(x.name, y.name) AS b FROM ed JOIN lb x ON x.vec_id = ed.a JOIN lb y ON y.vec_id = ed.b WHERE x.name <> y.name AND sim > 0.3")
def cluster_splits(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    names = t.vectors.select("vec_id", F.concat(F.lit("L"), F.col("vec_id") % 4).alias("name"))
    both = edges(t).where("sim > 0.3").join(names.toDF("a", "x"), "a").join(names.toDF("b", "y"), "b").where("x <> y")
    return both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


@query("CLU-23")
def canopy_growth(spark: SparkSession, d: str) -> DataFrame:
    v = Tables(spark, d).vectors.select("vec_id", "label", "e", (F.col("vec_id") % 13).alias("quality"), F.when(F.col("vec_id") % 9 == 0, F.concat(F.lit("n"), F.col("vec_id") % 4)).alias("name"))
    return C.canopies(v, "label", "vec_id", "e", "quality", "name", prototype=0.3, beta=0.6, sentinel=0.15)


@query("CLU-29")
def quick_check(spark: SparkSession, d: str) -> DataFrame:
    """Control flow: too few rows are one cluster; else the best valid split, or none."""
    v = Tables(spark, d).vectors
    few = v.limit(30).count() < 30
    _, report = ({}, {"k": 1}) if few else C.k_means(v, range(2, 5), components=32, least_size=10, least_silhouette=0.15)
    return spark.range(1).select(F.lit(report["k"]).alias("k"), F.lit(few).alias("too_few"))


@query("CLU-24", """, n AS (SELECT vec_id, label, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e, vec_id % 13 AS q, CASE WHEN vec_id % 9 = 0 THEN 'n' || (vec_id % 4) END AS name FROM vec),
a AS (SELECT label, arg_max(vec_id, (q, -vec_id)) AS anchor FROM n GROUP BY 1), s AS (SELECT n.*, anchor, x.name AS an, list_dot_product(n.e, x.e) AS sim FROM n JOIN a USING (label) JOIN n x ON x.vec_id = anchor),
r AS (SELECT label, sim, row_number() OVER (PARTITION BY label ORDER BY sim DESC, vec_id) AS rk FROM s WHERE vec_id <> anchor), dn AS (SELECT label, avg(sim) AS d FROM r WHERE rk <= 10 GROUP BY 1),
gd AS (SELECT label, vec_id AS guard FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY sim DESC, vec_id) AS rk FROM s WHERE vec_id <> anchor) WHERE rk <= 4 UNION ALL SELECT label, anchor FROM a),
ps AS (SELECT n.vec_id, count(*) AS guards, count(*) FILTER (list_dot_product(n.e, g.e) >= 0.15) AS passing FROM n JOIN gd USING (label) JOIN n g ON g.vec_id = guard GROUP BY 1)
SELECT label, vec_id, CASE WHEN vec_id = anchor THEN 'anchor' WHEN sim < 0.2 THEN 'prototype' WHEN sim < 0.6 * d THEN 'density' WHEN guards >= 3 AND passing < least(2, greatest(1, guards // 2)) THEN 'sentinel' WHEN name IS NOT NULL AND name IS DISTINCT FROM an THEN 'name' ELSE 'passed' END AS verdict FROM s JOIN ps USING (vec_id) LEFT JOIN dn USING (label)""")
def gate_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """How each row of a label fares at the gates of the canopy around the label's best row."""
    v = Tables(spark, d).vectors.select("vec_id", "label", "e", (F.col("vec_id") % 13).alias("quality"), F.when(F.col("vec_id") % 9 == 0, F.concat(F.lit("n"), F.col("vec_id") % 4)).alias("name"))
    return C.gate_verdicts(v, "label", "vec_id", "e", "quality", "name", prototype=0.2, beta=0.6, sentinel=0.15)
