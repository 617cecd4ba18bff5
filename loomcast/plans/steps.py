"""Composable analysis: registered steps over a context of DataFrames, chains, presets.

A step is a function (context, parameters) -> context. Nothing runs before a frame of
the result is read. Models stay outside: embedding, expansion and text generation are
functions that the caller registers, with deterministic defaults.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.functions import predicates as P
from loomcast.functions import scores as S
from loomcast.functions import text as X
from loomcast.functions.models import batched
from loomcast.functions.text_udfs import hashed_vector_of
from loomcast.operators import cluster as C
from loomcast.operators import search as Q
from loomcast.operators.ann import near_graph
from loomcast.operators.density import density_clusters
from loomcast.operators.features import agglomerative
from loomcast.operators.reliable import cut as reliable
from loomcast.operators.windows import top, top_per_group
from loomcast.plans.registry import Tables, query
from loomcast.plans.searching import greedy_sql


@dataclass(frozen=True)
class Context:
    """What a chain has so far: the corpus, what was retrieved and frames by name."""

    segments: DataFrame
    as_of: str
    question: str = ""
    frames: Mapping[str, DataFrame] = field(default_factory=dict)
    plugins: Mapping[str, Callable] = field(default_factory=dict)

    def put(self, **frames: DataFrame) -> Context:
        return replace(self, frames={**self.frames, **frames})

    def current(self) -> DataFrame:
        return self.frames.get("selected", self.frames.get("retrieved", self.segments))


Step = Callable[[Context, Mapping[str, Any]], Context]


@dataclass(frozen=True)
class Registered:
    run: Step
    defaults: Mapping[str, Any]


STEPS: dict[str, Registered] = {}


def step(name: str, /, **defaults: Any) -> Callable[[Step], Step]:
    def add(f: Step) -> Step:
        STEPS[name] = Registered(f, defaults)
        return f

    return add


def check(name: str, params: Mapping[str, Any]) -> dict[str, Any]:
    """Parameters with defaults; unknown steps and parameters are errors."""
    if name not in STEPS:
        raise ValueError(f"no step {name}")
    known = STEPS[name].defaults
    if unknown := sorted(set(params) - set(known)):
        raise ValueError(f"{name} has no parameter {', '.join(unknown)}")
    return {**known, **params}


class Chain:
    """A list of (step, parameters), built fluently or from JSON."""

    def __init__(self, steps: Sequence[tuple[str, Mapping[str, Any]]] = ()) -> None:
        self.steps = [(name, check(name, params)) for name, params in steps]

    def then(self, name: str, /, **params: Any) -> Chain:
        return Chain([*self.steps, (name, params)])

    @classmethod
    def from_json(cls, text: str) -> Chain:
        return cls([(s["step"], s.get("params", {})) for s in json.loads(text)])

    def stream(self, context: Context) -> Iterator[tuple[str, Context]]:
        """(step, context) as each step is done, so that a caller can show what there is so far."""
        for name, params in self.steps:
            context = STEPS[name].run(context, params)
            yield name, context

    def run(self, context: Context) -> Context:
        for _, context in self.stream(context):  # noqa: B007
            pass
        return context


def hashed_vector(text, dim: int = 64):
    """Default embedding of a column of texts: hashed_vector_of each, in batches as a model's would be."""
    return batched(f"hashed-{dim}", lambda: lambda texts: [hashed_vector_of(t, dim).tolist() for t in texts], "array<double>", 256)(text)


#: What the default expansion asks, by strategy; {q} is the question.
ASKED = {
    "multi_query": ("{q}", "what is said about {q}", "views on {q}", "debate about {q}", "news of {q}", "que dit-on de {q}", "opinions sur {q}", "débat sur {q}", "nouvelles de {q}", "analyse de {q}"),
    "theme_queries": ("{q}", "arguments for {q}", "arguments against {q}", "causes of {q}", "effects of {q}", "people in {q}", "history of {q}", "politics of {q}", "economy of {q}", "future of {q}"),
    "query2doc": ("{q} A passage on {q} would say what it is, who speaks of it and why it matters.",),
    "stance_variation": ("Someone in favour says of {q} that it helps.", "Someone against says of {q} that it harms.", "Someone neutral says of {q} that it depends.", "Someone concerned asks who pays for {q}.", "Someone hopeful expects much of {q}."),
}


def default_expand(question: str, strategy: str, n: int) -> list[str]:
    """Deterministic expansions: ten queries, one document or n stances; no model."""
    texts = ASKED[strategy][:n] if strategy == "stance_variation" else ASKED[strategy]
    return [t.replace("{q}", question) for t in texts]


def expanded(questions: DataFrame, strategies: Sequence[str], n: int) -> DataFrame:
    """questions (question, ...) with strategy, query_idx and text: default_expand of every question, as one expression."""
    asked = [(s, i, t) for s in strategies for i, t in enumerate(default_expand("{q}", s, n))]
    each = F.array(*[F.struct(F.lit(s).alias("strategy"), F.lit(i).alias("query_idx"), F.replace(F.lit(t), F.lit("{q}"), F.col("question")).alias("text")) for s, i, t in asked])
    return questions.withColumn("__x", F.explode(each)).select("*", "__x.*").drop("__x")


@step("expand_query", strategy="multi_query", n_stances=3)
def expand_query(c: Context, p: Mapping[str, Any]) -> Context:
    """frames.queries: (query_idx, text, qe). Plug-ins: expand(question, strategy, n) and embed(column)."""
    if p["strategy"] not in ASKED:
        raise ValueError(f"no strategy {p['strategy']}")
    texts = c.plugins.get("expand", default_expand)(c.question, p["strategy"], p["n_stances"])
    rows = c.segments.sparkSession.createDataFrame([(i, t) for i, t in enumerate(texts)], "query_idx int, text string")
    return c.put(queries=rows.withColumn("qe", c.plugins.get("embed", hashed_vector)(F.col("text"))))


FILTERS = {"time_window_days": 30, "must_contain": None, "must_contain_any": None, "projects": None, "languages": None, "channels": None}


def filtered(c: Context, p: Mapping[str, Any]) -> DataFrame:
    return c.segments.where(P.all_of(
        P.text_conditions("date", "text", p["time_window_days"], c.as_of, p.get("must_contain"), p.get("must_contain_any")),
        P.one_of("project", p["projects"]), P.one_of("lang", p["languages"]), P.one_of("channel", p["channels"]),
    ))


@step("retrieve_segments", k=200, threshold=0.42, **FILTERS)
def retrieve_segments(c: Context, p: Mapping[str, Any]) -> Context:
    """With queries, the k nearest of each above threshold, the first query's hit kept; without, what the filters keep."""
    kept = filtered(c, p)
    if "queries" not in c.frames:
        return c.put(retrieved=kept)
    hits = Q.search(kept, c.frames["queries"], p["k"], p["threshold"], vec_id="segment_id", query_id="query_idx")
    return c.put(retrieved=top_per_group(hits, ["content_id", "start_time"], [F.col("query_idx"), F.col("sim").desc(), F.col("segment_id")]))


STEPS["retrieve_segments_by_search"] = STEPS["retrieve_segments"]


@step("retrieve_all_segments", time_window_days=30, projects=None, languages=None, channels=None, must_be_stitched=True, must_be_embedded=True)
def retrieve_all_segments(c: Context, p: Mapping[str, Any]) -> Context:
    kept = filtered(c, {**FILTERS, **{k: p[k] for k in ("time_window_days", "projects", "languages", "channels")}})
    return c.put(retrieved=kept.where(F.col("e").isNotNull()) if p["must_be_embedded"] else kept)


@step("corpus_analysis", include_duration=True, include_episode_count=True)
def corpus_analysis(c: Context, p: Mapping[str, Any]) -> Context:
    aggs = [F.count(F.lit(1)).alias("n_segments"), F.count_distinct("channel").alias("n_channels")]
    aggs += [F.count_distinct("content_id").alias("n_episodes")] * p["include_episode_count"] + [F.sum("length").alias("duration")] * p["include_duration"]
    return c.put(corpus=c.current().agg(*aggs))


def clustered(rows: DataFrame, p: Mapping[str, Any]) -> DataFrame:
    """rows with cluster by p's method: hdbscan (density), agglomerative (Ward) or kmeans; -1 is noise.

    use_faiss takes the density method's neighbours from an inverted-file index instead of all pairs.
    """
    if p["method"] == "kmeans":
        return C.k_means(rows, [p["n_clusters"]] if p["n_clusters"] else range(2, p["max_themes"] + 1), least_size=1)[0]
    if p["method"] == "agglomerative":
        if not p["n_clusters"]:
            raise ValueError("agglomerative needs n_clusters")
        found = agglomerative(rows, p["n_clusters"], vec_id="segment_id")
    elif p["method"] == "hdbscan":
        graph = near_graph(rows, max(15, p["min_samples"] or p["min_cluster_size"]), "segment_id") if p["use_faiss"] else None
        found = density_clusters(rows, p["min_cluster_size"], p["min_samples"], vec_id="segment_id", graph=graph)
    else:
        raise ValueError(f"no method {p['method']}")
    return rows.join(found, "segment_id")


@step("extract_themes", method="hdbscan", max_themes=10, min_theme_percentage=5.0, use_faiss=False, n_clusters=None, min_cluster_size=5, min_samples=None)
def extract_themes(c: Context, p: Mapping[str, Any]) -> Context:
    """frames.themed: rows with cluster; -1 for noise, where a theme is too small, and beyond the max_themes largest."""
    out = reliable(clustered(c.current().where(F.col("e").isNotNull()), p))
    sizes = out.where("cluster <> -1").groupBy("cluster").agg(F.count(F.lit(1)).alias("__n"))
    least = out.agg((F.count(F.lit(1)) * p["min_theme_percentage"] / 100).alias("__least"))
    large = sizes.crossJoin(F.broadcast(least)).where((F.col("__n") >= F.col("__least")) & (F.col("__n") >= p["min_cluster_size"]))
    fit = top(large, [F.col("__n").desc(), F.col("cluster")], p["max_themes"]).select("cluster", F.lit(True).alias("__fit"))
    return c.put(themed=out.join(fit, "cluster", "left").withColumn("cluster", F.when(F.col("__fit"), F.col("cluster")).otherwise(-1)).drop("__fit"))


@step("quick_cluster_check", method="fast", min_cluster_size=10, min_silhouette_score=0.15, skip_if_few_segments=30, max_themes=4, force_split=True)
def quick_cluster_check(c: Context, p: Mapping[str, Any]) -> Context:
    rows = c.current().where(F.col("e").isNotNull())
    if rows.limit(p["skip_if_few_segments"]).count() < p["skip_if_few_segments"]:
        return c.put(themed=rows.withColumn("cluster", F.lit(0)))
    if p["method"] == "hdbscan":
        return c.put(themed=rows.join(density_clusters(rows, p["min_cluster_size"], vec_id="segment_id"), "segment_id"))
    if p["method"] != "fast":
        raise ValueError(f"no method {p['method']}")
    floor = -1.0 if p["force_split"] else p["min_silhouette_score"]
    out, _ = C.k_means(rows, range(2, p["max_themes"] + 1), components=32, least_size=p["min_cluster_size"], least_silhouette=floor)
    return c.put(themed=out)


#: Themes that extract_subthemes clusters one after the other; more are an error.
MAX_THEMES = 100


@step("extract_subthemes", method="kmeans", n_subthemes=3, min_cluster_size=3, require_valid_clusters=True, min_silhouette_score=0.15)
def extract_subthemes(c: Context, p: Mapping[str, Any]) -> Context:
    """frames.subthemed: rows with cluster and subtheme; the themes, a few, are clustered one after the other."""
    themed, parts = c.frames["themed"], None
    themes = themed.select("cluster").distinct().orderBy("cluster").limit(MAX_THEMES + 1).collect()
    if len(themes) > MAX_THEMES:
        raise ValueError(f"extract_subthemes takes at most {MAX_THEMES} themes")
    for (theme,) in themes:
        floor = p["min_silhouette_score"] if p["require_valid_clusters"] else -1.0
        out, _ = C.k_means(themed.where(F.col("cluster") == theme).withColumnRenamed("cluster", "__theme"), [p["n_subthemes"]], least_size=p["min_cluster_size"], least_silhouette=floor)
        part = out.withColumnRenamed("cluster", "subtheme").withColumnRenamed("__theme", "cluster")
        parts = part if parts is None else parts.unionByName(part)
    return c.put(subthemed=parts)


@step("rerank_segments", best_per_episode=True, max_per_channel=None, similarity_weight=0.4, popularity_weight=0.2, recency_weight=0.2, single_speaker_weight=0.1, named_speaker_weight=0.1, time_window_days=30, similarity_floor=0.0, keyword_weight=0.0)
def rerank_segments(c: Context, p: Mapping[str, Any]) -> Context:
    rows = c.current()
    rows = rows if "sim" in rows.columns else rows.withColumn("sim", F.lit(0.0))
    age = S.days_between(F.lit(c.as_of).cast("timestamp"), F.col("date"))
    signals = {
        "similarity": F.col("sim"), "popularity": S.log_popularity_fixed(F.col("popularity")), "recency": S.linear_recency(age, p["time_window_days"]),
        "single_speaker": F.when(F.col("n_speakers") == 1, 1.0).otherwise(0.0), "named_speaker": F.when(F.col("speaker").isNotNull(), 1.0).otherwise(0.0),
    }
    weights = {k: p[f"{k}_weight"] for k in signals}
    bonus = p["keyword_weight"] * X.keyword_share(F.col("text"), c.question.split()) if p["keyword_weight"] else None
    out = Q.rerank(rows, signals, weights, p["similarity_floor"], "sim", "content_id" if p["best_per_episode"] else None, "channel", p["max_per_channel"], "segment_id", bonus)
    return c.put(retrieved=out)


@step("select_segments", strategy="balanced", n=20, n_unclustered=6)
def select_segments(c: Context, p: Mapping[str, Any]) -> Context:
    """frames.selected: diverse rows of each theme (n_unclustered of those in none), or of all without themes; rank: by score alone; balanced: by channel."""
    rows = c.frames.get("themed", c.current())
    rows = rows.withColumn("__score", F.col("final_score") if "final_score" in rows.columns else F.col("sim") if "sim" in rows.columns else F.lit(0.0))
    keys = ["cluster"] if "cluster" in rows.columns else ["channel"] if p["strategy"] == "balanced" else []
    if p["strategy"] == "rank":
        return c.put(selected=Q.select_top(rows, "__score", "segment_id", p["n"]))
    if p["strategy"] not in ("balanced", "diversity"):
        raise ValueError(f"no strategy {p['strategy']}")
    picked = Q.diverse(rows, "__score", "e", "segment_id", p["n"], keys=keys)
    if keys == ["cluster"]:
        picked = picked.where((F.col("cluster") != -1) | (F.col("picked") <= p["n_unclustered"]))
    return c.put(selected=picked)


@step("quantitative_analysis", include_baseline=False, time_window_days=7)
def quantitative_analysis(c: Context, p: Mapping[str, Any]) -> Context:
    """frames.quantities: counts of what is selected, with the corpus's own counts as a baseline."""
    out = c.current().agg(F.count(F.lit(1)).alias("n"), F.count_distinct("channel").alias("n_channels"), F.count_distinct("content_id").alias("n_episodes"))
    if p["include_baseline"]:
        recent = c.segments.where(P.within_days("date", p["time_window_days"], c.as_of))
        out = out.crossJoin(recent.agg(F.count(F.lit(1)).alias("baseline_n"), F.count_distinct("channel").alias("baseline_channels")))
    return c.put(quantities=out)


@step("generate_summary", template="rag_answer", level="theme", model=None, backend=None, temperature=0.3, max_tokens=400, max_concurrent=20, include_subtheme_summaries=False, include_theme_summaries=False, include_all_theme_summaries=False)
def generate_summary(c: Context, p: Mapping[str, Any]) -> Context:
    """frames.summaries: (group, prompt, summary). Plug-in: generate(column); the default is the first max_tokens words of the prompt.

    The default needs no more than max_tokens texts with words of each group, so it takes no more to one row.
    """
    rows = c.current()
    key = F.col("cluster").cast("string") if p["level"] == "theme" and "cluster" in rows.columns else F.lit("all")
    if "generate" not in c.plugins:
        rows = top_per_group(rows.where(F.col("text").rlike(r"\S")), [key], [F.col("segment_id"), F.col("text")], p["max_tokens"])
    texts = rows.groupBy(key.alias("group")).agg(F.array_sort(F.collect_list(F.struct("segment_id", "text"))).alias("t"))
    prompt = F.concat(F.lit(TEMPLATES[p["template"]].format(question=c.question)), F.array_join("t.text", "\n"))
    first = lambda col: F.array_join(F.slice(F.split(col, r"\s+"), 1, p["max_tokens"]), " ")
    generate = c.plugins.get("generate", first)
    return c.put(summaries=texts.select("group", prompt.alias("prompt")).withColumn("summary", generate(F.col("prompt"))))


STEPS["generate_summaries"] = STEPS["generate_summary"]
#: Prompt templates by name; more may be added.
TEMPLATES = {"rag_answer": "Answer from the passages: {question}\n", "theme_summary": "Summarise the theme of: {question}\n", "corpus_summary": "Summarise the corpus for: {question}\n", "subtheme_summary": "Summarise the subtheme of: {question}\n"}


@step("group_by", field="channel")
def group_by(c: Context, p: Mapping[str, Any]) -> Context:
    return c.put(groups=c.current().groupBy(p["field"]).agg(F.sort_array(F.collect_list("segment_id")).alias("segment_ids")))


@step("custom_step", name="custom", func=None, params=None)
def custom_step(c: Context, p: Mapping[str, Any]) -> Context:
    """func(frame, **params) over the current frame."""
    return c.put(**{p["name"]: c.current().transform(p["func"], **(p["params"] or {}))})


@step("analyze_themes_with_subthemes", quick_cluster_check=None, quantitative_per_theme=True, select_segments_per_subtheme=8, select_unclustered=6, generate_theme_names=True, model=None, max_concurrent=8)
def analyze_themes(c: Context, p: Mapping[str, Any]) -> Context:
    """frames.selected by theme, frames.theme_quantities and frames.theme_names (the frequent words of each)."""
    c = c if "themed" in c.frames else STEPS["quick_cluster_check"].run(c, check("quick_cluster_check", p["quick_cluster_check"] or {}))
    themed = c.frames["themed"]
    c = STEPS["select_segments"].run(c, check("select_segments", {"strategy": "diversity", "n": p["select_segments_per_subtheme"], "n_unclustered": p["select_unclustered"]}))
    if p["quantitative_per_theme"]:
        c = c.put(theme_quantities=themed.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("channel").alias("n_channels")))
    if p["generate_theme_names"]:
        words = themed.select("cluster", F.explode(F.array_distinct(F.filter(F.split(F.lower("text"), r"(?U)[^\w]+"), lambda w: F.length(w) > 3))).alias("w"))
        frequent = top_per_group(words.groupBy("cluster", "w").agg(F.count(F.lit(1)).alias("n")), ["cluster"], [F.col("n").desc(), F.col("w")], 3)
        c = c.put(theme_names=frequent.groupBy("cluster").agg(F.array_join(F.array_sort(F.collect_list("w")), ", ").alias("name")))
    return c


_SUMMARY = {"temperature": 0.3}
#: Chains by name: the steps in order, with the parameters that differ from the defaults.
PRESETS: dict[str, list[tuple[str, dict[str, Any]]]] = {
    "search_only": [("expand_query", {}), ("retrieve_segments", {"k": 200})],
    "simple_rag": [
        ("expand_query", {}), ("retrieve_segments", {"k": 200}),
        ("rerank_segments", {"similarity_weight": 0.35, "popularity_weight": 0.25, "recency_weight": 0.25, "single_speaker_weight": 0.08, "named_speaker_weight": 0.07, "similarity_floor": 0.42, "keyword_weight": 0.15}),
        ("quick_cluster_check", {"min_silhouette_score": 0.25}), ("select_segments", {"n": 20}), ("generate_summary", {}),
    ],
    "quick_summary": [("expand_query", {}), ("retrieve_segments", {"k": 50}), ("select_segments", {"n": 15}), ("generate_summary", {"max_tokens": 600, **_SUMMARY})],
    "hierarchical_summary": [("retrieve_segments", {}), ("extract_themes", {}), ("quantitative_analysis", {}), ("select_segments", {"strategy": "diversity"}), ("generate_summary", {"template": "theme_summary"}), ("generate_summary", {"template": "corpus_summary", "level": "corpus"})],
    "hierarchical_with_subthemes": [("retrieve_segments", {}), ("extract_themes", {}), ("extract_subthemes", {}), ("quantitative_analysis", {}), ("select_segments", {"strategy": "diversity", "n": 10}), ("generate_summary", {"template": "subtheme_summary"}), ("generate_summary", {"template": "theme_summary"})],
    "deep_analysis": [("expand_query", {"strategy": "stance_variation", "n_stances": 5}), ("retrieve_segments", {"k": 300}), ("extract_themes", {}), ("quantitative_analysis", {"include_baseline": True}), ("select_segments", {"strategy": "diversity"}), ("generate_summary", {"template": "theme_summary"})],
    "discourse_summary": [("retrieve_all_segments", {"time_window_days": 14}), ("corpus_analysis", {}), ("extract_themes", {"min_cluster_size": 50, "min_theme_percentage": 4.0}), ("select_segments", {"strategy": "diversity", "n": 15}), ("generate_summary", {"template": "theme_summary"})],
    "landing_page_overview": [("retrieve_all_segments", {"time_window_days": 14}), ("corpus_analysis", {}), ("extract_themes", {"min_cluster_size": 50, "max_themes": 8}), ("analyze_themes_with_subthemes", {}), ("generate_summary", {"template": "corpus_summary"})],
}
PRESETS["discourse_summary_local"] = PRESETS["discourse_summary"]


def preset(name: str) -> Chain:
    return Chain(PRESETS[name])


def corpus(t: Tables) -> DataFrame:
    """Documents as segments, with the vector of the same number where there is one."""
    docs = t.documents.join(t.vectors.select(F.col("vec_id").alias("doc_id"), "e"), "doc_id", "left")
    return docs.select(
        F.col("doc_id").alias("segment_id"), F.floor(F.col("doc_id") / 3).alias("content_id"), (F.col("doc_id") % 3 * 10.0).alias("start_time"), "text", "lang", F.col("source").alias("channel"), F.col("lang").alias("project"),
        F.expr("timestamp'2024-01-31' - make_interval(0, 0, 0, int(doc_id % 40))").alias("date"), F.col("n_chars").cast("double").alias("length"), (F.col("doc_id") % 90).cast("double").alias("popularity"),
        (1 + F.col("doc_id") % 2).alias("n_speakers"), F.when(F.col("doc_id") % 5 != 0, F.concat(F.lit("s"), F.col("doc_id") % 7)).alias("speaker"), "e",
    )


def context(spark: SparkSession, d: str, question: str = "the and thing") -> Context:
    return Context(corpus(Tables(spark, d)), "2024-01-31 00:00:00", question)


CORPUS = ", cp AS (SELECT doc_id, source, lang, n_chars, doc_id // 3 AS content_id, doc_id % 40 AS age FROM documents) "


def _expansions() -> str:
    rows = ", ".join(f"('{s}', {i}, '{t}')" for s in sorted(ASKED) for i, t in enumerate(ASKED[s][: 3 if s == "stance_variation" else None]))
    return f"SELECT item_id, strategy, query_idx, replace(template, '{{q}}', text) AS text FROM benchmark, (VALUES {rows}) v(strategy, query_idx, template)"


@query("STP-1", _expansions())
def stp_expand(spark: SparkSession, d: str) -> DataFrame:
    """What each strategy asks of every item of the benchmark."""
    items = Tables(spark, d).raw("benchmark").select("item_id", F.col("text").alias("question"))
    return expanded(items, sorted(ASKED), 3).select("item_id", "strategy", "query_idx", "text")


@query("STP-2")
def stp_search(spark: SparkSession, d: str) -> DataFrame:
    c = context(spark, d)
    c = replace(c, segments=c.segments.withColumn("e", hashed_vector(F.col("text"))))
    return Chain().then("expand_query").then("retrieve_segments_by_search", k=50, threshold=0.05).run(c).frames["retrieved"].select("segment_id", "query_idx", "sim")


@query("STP-3", CORPUS + "SELECT doc_id AS segment_id FROM cp JOIN documents USING (doc_id) WHERE age <= 30 AND text ILIKE '%the%' AND cp.lang IN ('en', 'de')")
def stp_retrieve(spark: SparkSession, d: str) -> DataFrame:
    return Chain().then("retrieve_segments", must_contain=["the"], languages=["en", "de"]).run(context(spark, d)).frames["retrieved"].select("segment_id")


@query("STP-4", CORPUS + "SELECT doc_id AS segment_id FROM cp WHERE age <= 14 AND doc_id IN (SELECT vec_id FROM vec)")
def stp_retrieve_all(spark: SparkSession, d: str) -> DataFrame:
    return Chain().then("retrieve_all_segments", time_window_days=14).run(context(spark, d)).frames["retrieved"].select("segment_id")


@query("STP-5", CORPUS + "SELECT count(*) AS n_segments, count(DISTINCT source) AS n_channels, count(DISTINCT content_id) AS n_episodes, sum(n_chars)::DOUBLE AS duration FROM cp")
def stp_corpus(spark: SparkSession, d: str) -> DataFrame:
    return Chain().then("corpus_analysis").run(context(spark, d)).frames["corpus"]


@query("STP-6")
def stp_themes(spark: SparkSession, d: str) -> DataFrame:
    return Chain().then("retrieve_all_segments").then("analyze_themes_with_subthemes").run(context(spark, d)).frames["selected"].select("cluster", "segment_id", "picked")


@query("STP-7")
def stp_extract(spark: SparkSession, d: str) -> DataFrame:
    return Chain().then("retrieve_all_segments").then("extract_themes", method="kmeans", n_clusters=4).run(context(spark, d)).frames["themed"].groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@query("STP-8")
def stp_check(spark: SparkSession, d: str) -> DataFrame:
    return Chain().then("retrieve_all_segments").then("quick_cluster_check").run(context(spark, d)).frames["themed"].groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@query("STP-9")
def stp_sub(spark: SparkSession, d: str) -> DataFrame:
    chain = Chain().then("retrieve_all_segments").then("extract_themes", method="kmeans", n_clusters=2).then("extract_subthemes", require_valid_clusters=False)
    return chain.run(context(spark, d)).frames["subthemed"].groupBy("cluster", "subtheme").agg(F.count(F.lit(1)).alias("n"))


@query("STP-10", CORPUS + greedy_sql("SELECT source AS g, doc_id AS vec_id, 0.0::DOUBLE AS static, e FROM cp JOIN vec ON vec_id = doc_id WHERE age <= 30", 3, 0.5) + "SELECT g AS channel, vec_id AS segment_id, picked FROM picks")
def stp_select(spark: SparkSession, d: str) -> DataFrame:
    return Chain().then("retrieve_all_segments").then("select_segments", n=3).run(context(spark, d)).frames["selected"].select("channel", "segment_id", "picked")


@query("STP-11", CORPUS + """, s AS (SELECT doc_id, content_id, source, round(0.4 * 0 + 0.2 * ln(1 + doc_id % 90) / ln(101) + 0.2 * greatest(0, 1 - age / 30) + 0.1 * CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END + 0.1 * CASE WHEN doc_id % 5 <> 0 THEN 1 ELSE 0 END, 6) AS final_score FROM cp WHERE age <= 30),
e1 AS (SELECT *, row_number() OVER (PARTITION BY content_id ORDER BY final_score DESC, doc_id) AS rn FROM s), c1 AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY final_score DESC, doc_id) AS rc FROM e1 WHERE rn = 1)
SELECT doc_id AS segment_id, final_score FROM c1 WHERE rc <= 4""")
def stp_rerank(spark: SparkSession, d: str) -> DataFrame:
    return Chain().then("retrieve_segments").then("rerank_segments", max_per_channel=4).run(context(spark, d)).frames["retrieved"].select("segment_id", "final_score")


@query("STP-12", CORPUS + r"""SELECT 'all' AS "group", array_to_string(regexp_split_to_array('Answer from the passages: the and thing' || chr(10) || string_agg(text, chr(10) ORDER BY doc_id), '[ \t\n\v\f\r]+')[1:50], ' ') AS summary FROM cp JOIN documents USING (doc_id) WHERE age <= 30 AND text ILIKE '%licensed%'""")
def stp_summaries(spark: SparkSession, d: str) -> DataFrame:
    return Chain().then("retrieve_segments", must_contain=["licensed"]).then("generate_summaries", level="corpus", max_tokens=50).run(context(spark, d)).frames["summaries"].select("group", "summary")


@query("STP-13", CORPUS + "SELECT count(*) FILTER (age <= 10) AS n, count(DISTINCT source) FILTER (age <= 10) AS n_channels, count(DISTINCT content_id) FILTER (age <= 10) AS n_episodes, count(*) FILTER (age <= 7) AS baseline_n, count(DISTINCT source) FILTER (age <= 7) AS baseline_channels FROM cp")
def stp_quantities(spark: SparkSession, d: str) -> DataFrame:
    return Chain().then("retrieve_segments", time_window_days=10).then("quantitative_analysis", include_baseline=True).run(context(spark, d)).frames["quantities"]


@query("STP-14", CORPUS + "SELECT source AS channel, array_to_string(list_sort(list(doc_id)), ',') AS ids FROM cp WHERE age <= 30 GROUP BY 1")
def stp_group(spark: SparkSession, d: str) -> DataFrame:
    groups = Chain().then("retrieve_segments").then("group_by", field="channel").run(context(spark, d)).frames["groups"]
    return groups.select("channel", F.array_join(F.col("segment_ids").cast("array<string>"), ",").alias("ids"))


@query("STP-15", CORPUS + "SELECT lang, count(*) AS n FROM cp WHERE age <= 30 GROUP BY 1")
def stp_custom(spark: SparkSession, d: str) -> DataFrame:
    def by_language(df: DataFrame, column: str) -> DataFrame:
        return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))

    return Chain().then("retrieve_segments").then("custom_step", name="langs", func=by_language, params={"column": "lang"}).run(context(spark, d)).frames["langs"]


@query("UDF-5", CORPUS + "SELECT count(*) AS n_segments, count(DISTINCT source) AS n_channels FROM cp WHERE age <= 20 AND doc_id IN (SELECT vec_id FROM vec)")
def built_from_json(spark: SparkSession, d: str) -> DataFrame:
    text = json.dumps([{"step": "retrieve_all_segments", "params": {"time_window_days": 20}}, {"step": "corpus_analysis", "params": {"include_duration": False, "include_episode_count": False}}])
    return Chain.from_json(text).run(context(spark, d)).frames["corpus"]


@query("UDF-6")
def preset_discourse(spark: SparkSession, d: str) -> DataFrame:
    chain = Chain([(n, {**p, **({"min_cluster_size": 5} if n == "extract_themes" else {})}) for n, p in PRESETS["discourse_summary"]])
    return chain.run(context(spark, d)).frames["summaries"].select("group", F.length("summary").alias("n_chars"))


@query("UDF-7")
def embedding_model(spark: SparkSession, d: str) -> DataFrame:
    v = Tables(spark, d).documents.select("doc_id", hashed_vector(F.col("text")).alias("v"))
    return v.select("doc_id", F.round(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x), 4).alias("norm"))

