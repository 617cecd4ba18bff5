"""The queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.llm import bpe, chat, divergence, exact_dedup, html_text, lattice, packing, pii, prefix_trie, quality, simhash, token_store, url_filter
from loomcast.llm.common import cut, documents, ensure_checkpoint_dir, table, tokenizer_file


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", simhash.fingerprint_hex().alias("fingerprint"), "component_id")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json")))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    safe = pii.protect(documents(spark, sf_dir).select("doc_id", "text"), pii.session_key(spark))
    return safe.select("doc_id", "text", pii.total().cast("long").alias("n_replaced"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


#: (action, rule) of the query's list.
URL_RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))


def page_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(url, bad) of labelled pages: the number in a page's path is the document that it shows.

    A page is bad if a label marks its document as of low quality or toxic.
    """
    shown = F.expr("try_cast(regexp_extract(path, '^/[a-z]+/([0-9]+)', 1) as bigint)")
    pages = url_filter.split_url(table(spark, sf_dir, "pages").select("url"), "url").withColumn("doc_id", shown)
    bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max(bad).alias("bad"))
    return pages.join(labels, "doc_id").select("url", "bad")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.judge(pages, page_outcomes(spark, sf_dir), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "n_labelled")


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.sql(f"select cast(-1 as bigint) conv_id, cast(i as bigint) turn, r role, '{said}' text from values (0, 'user'), (1, 'assistant') as t(i, r)")
    return chat.digest(chat.format_chats(turns.unionByName(extra)))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = tokenizer_file("byte_bpe_50k.tiktoken")
    coded = bpe.decode(bpe.encode(documents(spark, sf_dir), path, public_tokenizers.PATTERN, in_order=True), path)
    return coded.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


def quality_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> quality.Model:
    """Fitted on the labelled rows of docs that are not held out."""
    return quality.fit(docs, table(spark, sf_dir, "labels").where(~quality.held_out()))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = quality.score(docs, quality_model(spark, sf_dir, docs))
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def op12_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/tokens-{uuid.uuid4().hex}"
    token_store.write(documents(spark, sf_dir), folder, tokenizer_file("byte_bpe_50k.json"))
    return token_store.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered turns and all ids of the query's conversations: each begins with the first turns of its hundred's first one."""
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size"))
    convs = sizes.select("conv_id", (F.col("conv_id") - F.col("conv_id") % 100).alias("donor"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).alias("h"))
    given = turns.where("conv_id % 100 = 0 and pos < 5").withColumnRenamed("conv_id", "donor")
    first = convs.join(given, "donor").where("pos < h").select("conv_id", "pos", "key", "chars")
    heads = convs.join(sizes.where("conv_id % 100 = 0").select(F.col("conv_id").alias("donor"), "size"), "donor", "left")
    heads = heads.select("conv_id", "h", F.least("h", F.coalesce("size", F.lit(0))).alias("n"))
    own = turns.join(heads, "conv_id").where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("n")).alias("pos"), "key", "chars")
    return first.unionByName(own), convs.select("conv_id")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    numbered = cut(prefix_trie.numbered_turns(turns, *(F.col(c) for c in ("conv_id", "turn", "role", "text"))))
    return prefix_trie.trie(*rebuilt(numbered))


OP4_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       coalesce(doc_id = min(doc_id) OVER w, false) AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""


OP6_SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM u
), l AS (SELECT doc_id, bool_or(coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1) AS bad FROM labels GROUP BY 1),
o AS (SELECT host, bad FROM p JOIN l ON l.doc_id = TRY_CAST(regexp_extract(path, '^/[a-z]+/([0-9]+)', 1) AS BIGINT)),
parts AS (SELECT DISTINCT host, string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS a FROM p),
own AS (SELECT host, CASE WHEN regexp_matches(host, '^[0-9.]+(:[0-9]*)?$|^\[') THEN 0
          WHEN len(a) > 2 AND length(a[-1]) = 2 AND a[-2] IN ('ac', 'co', 'com', 'edu', 'gob', 'gov', 'govt', 'ltd', 'mil', 'ne', 'net', 'nom', 'or', 'org', 'plc', 'sch') THEN 2 ELSE 1 END AS k, a FROM parts),
names AS (SELECT host, array_to_string(CASE WHEN k = 0 THEN a ELSE a[greatest(1, len(a) - k + 1):] END, '.') AS suffix, array_to_string(CASE WHEN k = 0 THEN a ELSE a[greatest(1, len(a) - k):] END, '.') AS domain FROM own),
h AS (SELECT host, suffix, domain, count(*)::DOUBLE AS n, sum(bad::INT)::DOUBLE AS y FROM o JOIN names USING (host) GROUP BY 1, 2, 3),
d AS (SELECT domain, suffix, sum(n) AS n, sum(y) AS y FROM h GROUP BY 1, 2),
s AS (SELECT suffix, sum(n) AS n, sum(y) AS y FROM d GROUP BY 1),
g AS (SELECT 'h' AS lev, n, y FROM h UNION ALL SELECT 'd', n, y FROM d UNION ALL SELECT 's', n, y FROM s),
a AS (SELECT lev, count(*) AS k, sum(n) AS n, sum(y) AS y, sum(y * y / n) AS yy, sum(1 / n) AS inv FROM g GROUP BY 1),
b AS (SELECT lev, y / n AS p, k, inv, CASE WHEN k > 1 THEN k * (yy - n * (y / n) * (y / n)) / ((k - 1) * n) END AS spread FROM a),
m AS (SELECT lev, p, greatest(1.0, least(1e4, CASE WHEN k > 1 AND spread - p * (1 - p) * inv / k > 0
        THEN (p * (1 - p) - spread) / (spread - p * (1 - p) * inv / k) ELSE 1e4 END)) AS m FROM b),
sr AS (SELECT suffix, (y + m.m * m.p) / (n + m.m) AS r FROM s, m WHERE lev = 's'),
dr AS (SELECT domain, (y + m.m * sr.r) / (n + m.m) AS r FROM d JOIN sr USING (suffix), m WHERE lev = 'd'),
al AS (SELECT coalesce(y / n, 0) AS r FROM (SELECT sum(n) AS n, sum(y) AS y FROM h)), hm AS (SELECT coalesce(max(m), 1e4) AS m FROM m WHERE lev = 'h'),
pr AS (SELECT names.host, coalesce(h.n, 0) AS n, coalesce(h.y, 0) AS y, hm.m, coalesce(dr.r, sr.r, al.r) AS prior
       FROM names LEFT JOIN h USING (host) LEFT JOIN dr ON dr.domain = names.domain LEFT JOIN sr ON sr.suffix = names.suffix, al, hm),
hr AS (SELECT host, n, (y + m * prior) / (n + m) AS r, n + m AS w FROM pr),
ru(action, rule) AS (VALUES ('block', 'com/en/'), ('allow', 'example.com/en/7'), ('allow', 'net/de/'), ('block', 'example.net/de/8'), ('block', 'org/es/')),
f AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action FROM p JOIN ru
  ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1))) AND starts_with(path, substr(rule, strpos(rule, '/'))) GROUP BY 1
)
SELECT p.page_id, p.host, p.path, f.rule,
       coalesce(f.action, CASE WHEN hr.r - 1.645 * sqrt(hr.r * (1 - hr.r) / (hr.w + 1)) >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(hr.n, 0)::BIGINT AS n_labelled
FROM p LEFT JOIN f USING (page_id) LEFT JOIN hr ON hr.host = p.host
"""

OP7_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(12 + length(replace(replace(role, '<|', '<||'), chr(10), '<|n')) + 1 + length(replace(text, '<|', '<||')) + 11)::BIGINT AS formatted_chars,
       regexp_full_match(string_agg(role, ',' ORDER BY turn, role, text), '(system,)?user,assistant(,user,assistant)*') AS valid
FROM t GROUP BY 1
"""

OP9_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98
), r(vec_id, c) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.vec_id WHERE r.c < l.b
), m AS (SELECT vec_id, min(c) AS component_id FROM r GROUP BY 1), n AS (SELECT a, count(*) AS k FROM l GROUP BY 1)
SELECT m.vec_id, coalesce(n.k, 0) AS n_links, m.component_id, m.vec_id = m.component_id AS kept
FROM m LEFT JOIN n ON n.a = m.vec_id
"""

OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS a, row_number() OVER () AS r FROM documents),
w AS (SELECT lang, source, r, unnest(a) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS df FROM w GROUP BY ALL),
kept AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM c GROUP BY ALL HAVING sum(df) >= 10),
g AS (SELECT DISTINCT lang, source FROM d), v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY 1),
grid AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, k.n AS n_lang FROM g JOIN kept k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
t AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM grid GROUP BY ALL),
p AS (SELECT x.lang, x.source, x.term, x.n, 1 + (1000000000::HUGEINT * (x.n + 2)) // (t.total + 2 * v.v) AS p, 1 + (1000000000::HUGEINT * (x.n_lang + 2)) // (v.total + 2 * v.v) AS q
      FROM grid x JOIN t ON t.lang = x.lang AND t.source = x.source JOIN v ON v.lang = x.lang),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM o QUALIFY part = 'pair' OR rank <= 10
"""

OP13_SQL = r"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT conv_id, conv_id - conv_id % 100 AS donor,
    xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::UBIGINT)),
      lambda x, y: list_reduce(list_prepend(xor(x, y), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]), lambda s, z: CASE WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384::UBIGINT) ELSE s >> 1 END)), 4294967295::UBIGINT)::BIGINT % 6 AS h,
    count(*) AS n FROM t GROUP BY 1),
u AS (SELECT k.conv_id, t.pos, t.role, t.text FROM k JOIN t ON t.conv_id = k.donor AND t.pos < k.h
  UNION ALL SELECT k.conv_id, t.pos - k.h + least(k.h, coalesce(o.n, 0)), t.role, t.text FROM k JOIN t USING (conv_id) LEFT JOIN k o ON o.conv_id = k.donor WHERE t.pos >= k.h),
r AS (SELECT conv_id, pos::BIGINT + 1 AS depth, list({'role': role, 'text': text}) OVER (PARTITION BY conv_id ORDER BY pos) AS seq, length(text) AS chars FROM u
  UNION ALL SELECT conv_id, 0, [], 0 FROM k),
n AS (SELECT seq, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM r GROUP BY ALL),
p AS (SELECT r.conv_id, r.depth, n.conv_id AS node FROM r JOIN n ON n.seq = r.seq AND n.depth = r.depth),
c AS (SELECT n.conv_id, n.depth, n.n_convs, n.chars, p.node AS parent FROM n LEFT JOIN p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
e AS (SELECT conv_id, max(depth) AS depth FROM r GROUP BY 1), m AS (SELECT p.node, p.depth, string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) AS ids FROM p JOIN e USING (conv_id, depth) GROUP BY ALL),
y AS (SELECT parent, depth - 1 AS depth, count(*) AS k FROM c WHERE parent IS NOT NULL GROUP BY ALL),
f AS (SELECT c.*, coalesce(y.k, 0) AS n_children FROM c LEFT JOIN y ON y.parent = c.conv_id AND y.depth = c.depth),
z AS (SELECT p.node, p.depth, sum((f.n_children = 0)::INT) AS n_leaves, sum((f.n_convs - 1) * f.chars) AS saved FROM f JOIN p ON p.conv_id = f.conv_id AND p.depth <= f.depth GROUP BY ALL)
SELECT f.conv_id, f.depth, f.parent AS parent_conv_id, f.n_convs, f.n_children, z.n_leaves::BIGINT AS n_leaves, z.saved::BIGINT AS saved_tokens, sha256(coalesce(m.ids, '')) AS ends_sha256
FROM f JOIN z ON z.node = f.conv_id AND z.depth = f.depth LEFT JOIN m ON m.node = f.conv_id AND m.depth = f.depth
"""


QUERIES = (
    op1_simhash, op2_packing, op3_pii, op4_exact_dedup, op5_html_text,
    op6_url_filter, op7_chat, op8_byte_bpe, op9_lattice, op10_quality,
    op11_divergence, op12_wavelet, op13_prefix_trie,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op4_exact_dedup": OP4_SQL, "op6_url_filter": OP6_SQL, "op7_chat": OP7_SQL, "op9_lattice": OP9_SQL, "op11_divergence": OP11_SQL, "op13_prefix_trie": OP13_SQL}
