"""STR-10 and UDF registries: partial results, templates, step checks, text generation, hydration, verification, named SQL."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.plans import steps
from loomcast.plans.registry import Tables, query


@dataclass(frozen=True)
class Template:
    """A prompt: the system's message and a text with {names} that columns fill."""

    system: str
    prompt: str
    temperature: float = 0.3
    max_tokens: int = 400

    def render(self, **columns: Column) -> Column:
        """The prompt of each row; a name without a column is an error."""
        parts, rest = [F.lit(self.system + "\n")], self.prompt
        while "{" in rest:
            before, _, after = rest.partition("{")
            name, _, rest = after.partition("}")
            if name not in columns:
                raise ValueError(f"the template needs {name}")
            parts += [F.lit(before), F.coalesce(columns[name].cast("string"), F.lit(""))]
        return F.concat(*parts, F.lit(rest))


TEMPLATES: dict[str, Template] = {}


def register_template(name: str, system: str, prompt: str, temperature: float = 0.3, max_tokens: int = 400) -> Template:
    TEMPLATES[name] = Template(system, prompt, temperature, max_tokens)
    return TEMPLATES[name]


register_template("describe", "Be brief.", "Describe {kind} by user {user}.", max_tokens=8)


def generate(name: str, model: Callable[[Column], Column], **columns: Column) -> Column:
    """The model's text for each row's prompt, no longer than the template's words; model maps a column of prompts to one of texts."""
    template = TEMPLATES[name]
    return F.array_join(F.slice(F.split(model(template.render(**columns)), r"\s+"), 1, template.max_tokens), " ")


def hydrate(rows: DataFrame, key: str, sources: Sequence[tuple[str, DataFrame]], value: str) -> DataFrame:
    """rows with value and origin from the first source (name, (key, value)) that has it; keys are unique in a source."""
    out, found = rows, []
    for i, (name, source) in enumerate(sources):
        out = out.join(source.select(F.col(key), F.col(value).alias(f"__v{i}")), key, "left")
        found.append((F.col(f"__v{i}"), name))
    origin = reduce(lambda c, x: c.when(x[0].isNotNull(), x[1]), found[1:], F.when(found[0][0].isNotNull(), found[0][1]))
    return out.withColumns({value: F.coalesce(*[c for c, _ in found]), "origin": origin}).drop(*[f"__v{i}" for i in range(len(sources))])


@dataclass(frozen=True)
class Strategy:
    """A way to tell whether a row's host is verified: a confidence, or null where it can't tell."""

    name: str
    confidence: Column


def verify(rows: DataFrame, strategies: Sequence[Strategy], least: float = 0.7) -> DataFrame:
    """rows with strategy, confidence and verified: the first strategy that reaches least, else the most confident one."""
    told = F.array_compact(F.array(*[F.when(s.confidence.isNotNull(), F.struct(s.confidence.cast("double").alias("confidence"), F.lit(-i).alias("turn"), F.lit(s.name).alias("strategy"))) for i, s in enumerate(strategies)]))
    good = F.filter(told, lambda x: x["confidence"] >= least)
    best = F.when(F.size(good) > 0, good[0]).otherwise(F.array_max(told))
    return rows.withColumn("__best", best).withColumns({"strategy": F.col("__best.strategy"), "confidence": F.col("__best.confidence"), "verified": F.coalesce(F.col("__best.confidence") >= least, F.lit(False))}).drop("__best")


#: Jobs that a scheduler names: SQL with parameters of its own.
JOBS: dict[str, str] = {
    "count_since": "SELECT event_type, count(*) AS n FROM {events} WHERE ts >= to_timestamp(:since) GROUP BY event_type",
    "busiest": "SELECT user_id, count(*) AS n FROM {events} GROUP BY user_id HAVING count(*) >= :least",
}


def run_job(spark: SparkSession, name: str, args: Mapping[str, object], **tables: DataFrame) -> DataFrame:
    """A named job's result; its parameters reach the query as values, never as text."""
    return spark.sql(JOBS[name], args=dict(args), **tables)


@query("STR-10", """SELECT * FROM (VALUES (1, 'retrieve_segments', 1), (2, 'corpus_analysis', 2), (3, 'group_by', 3)) p(place, step, frames)
CROSS JOIN (SELECT count(*) FILTER (doc_id % 40 <= 30) AS rows FROM documents)""")
def streamed_results(spark: SparkSession, d: str) -> DataFrame:
    """What a caller sees after each step of a chain: the step, the frames so far and the rows retrieved."""
    chain = steps.Chain().then("retrieve_segments").then("corpus_analysis").then("group_by")
    parts = []
    for at, (name, context) in enumerate(chain.stream(steps.context(spark, d)), 1):
        n = context.frames["retrieved"].agg(F.count(F.lit(1)).alias("rows"))
        parts.append(n.select(F.lit(at).alias("place"), F.lit(name).alias("step"), F.lit(len(context.frames)).alias("frames"), "rows"))
    return reduce(DataFrame.unionByName, parts)


@query("UDF-3", "SELECT event_id, 'Be brief.' || chr(10) || 'Describe ' || event_type || ' by user ' || user_id || '.' AS prompt FROM ev")
def prompts(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events
    return e.select("event_id", TEMPLATES["describe"].render(kind=F.col("event_type"), user=F.col("user_id")).alias("prompt"))


def check_table(configs: DataFrame) -> DataFrame:
    """configs (step, params as JSON) with verdict: `ok`, or what the registry says against a step's name or parameters.

    The registry is a row for each step and is broadcast.
    """
    known = configs.sparkSession.createDataFrame([(name, sorted(r.defaults)) for name, r in steps.STEPS.items()], "step string, __known array<string>")
    odd = F.array_sort(F.array_except(F.coalesce(F.json_object_keys("params"), F.array()), "__known"))
    verdict = (
        F.when(F.col("__known").isNull(), F.concat(F.lit("no step "), F.coalesce("step", F.lit(""))))
        .when(F.size(odd) > 0, F.concat("step", F.lit(" has no parameter "), F.array_join(odd, ", "))).otherwise("ok")
    )
    return configs.join(F.broadcast(known), "step", "left").withColumn("verdict", verdict).drop("__known")


@query("UDF-4", """, c AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'retrieve_segments' WHEN 'error' THEN 'no_such_step' ELSE 'group_by' END AS step, json_keys(props) AS ks FROM ev)
SELECT event_id, step, CASE WHEN step = 'no_such_step' THEN 'no step no_such_step' WHEN step = 'group_by' AND len(ks) > 0 THEN 'group_by has no parameter ' || array_to_string(list_sort(ks), ', ') ELSE 'ok' END AS verdict FROM c""")
def checked_steps(spark: SparkSession, d: str) -> DataFrame:
    """A table of configurations held against the registry of steps; an event's properties are its step's parameters."""
    step = F.when(F.col("event_type") == "view", "retrieve_segments").when(F.col("event_type") == "error", "no_such_step").otherwise("group_by")
    return check_table(Tables(spark, d).events.select("event_id", step.alias("step"), F.col("props").alias("params"))).select("event_id", "step", "verdict")


@query("UDF-8", "SELECT event_id, upper('Be brief. Describe ' || event_type || ' by user ' || user_id || '.') AS answer FROM ev")
def generated(spark: SparkSession, d: str) -> DataFrame:
    """Text generated for each row by a model that the caller gives: here one that only raises its voice."""
    return Tables(spark, d).events.select("event_id", generate("describe", F.upper, kind=F.col("event_type"), user=F.col("user_id")).alias("answer"))


@query("UDF-9", """, a AS (SELECT speaker_id, max(confidence) AS score FROM segments WHERE emotion = 'R' GROUP BY 1), b AS (SELECT s_suppkey AS speaker_id, s_acctbal AS score FROM supplier WHERE s_suppkey % 2 = 0)
SELECT s_suppkey AS speaker_id, round(coalesce(a.score, b.score), 4) AS score, CASE WHEN a.score IS NOT NULL THEN 'segments' WHEN b.score IS NOT NULL THEN 'profile' END AS origin FROM supplier s LEFT JOIN a ON a.speaker_id = s_suppkey LEFT JOIN b ON b.speaker_id = s_suppkey""")
def hydrated(spark: SparkSession, d: str) -> DataFrame:
    """Speakers with a score from the first source that knows them."""
    t = Tables(spark, d)
    heard = t.segments.where("emotion = 'R'").groupBy("speaker_id").agg(F.max("confidence").alias("score"))
    profile = t.raw("supplier").where("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("speaker_id"), F.col("s_acctbal").alias("score"))
    out = hydrate(t.raw("supplier").select(F.col("s_suppkey").alias("speaker_id")), "speaker_id", [("segments", heard), ("profile", profile)], "score")
    return out.select("speaker_id", F.round("score", 4).alias("score"), "origin")


@query("UDF-10", """, c AS (SELECT event_id, CASE WHEN event_type = 'signup' THEN 0.95 END AS x, CASE WHEN k IS NOT NULL THEN k / 100.0 END AS y, 0.3 AS z FROM ev)
SELECT event_id, CASE WHEN x >= 0.7 THEN 'self' WHEN y >= 0.7 THEN 'mention' WHEN coalesce(y, 0) >= 0.3 THEN 'mention' ELSE 'guess' END AS strategy, CASE WHEN x >= 0.7 THEN 0.95 ELSE greatest(y, 0.3) END::DOUBLE AS confidence, coalesce(x >= 0.7, false) OR coalesce(y >= 0.7, false) AS verified FROM c""")
def verified_hosts(spark: SparkSession, d: str) -> DataFrame:
    ways = [Strategy("self", F.when(F.col("event_type") == "signup", 0.95)), Strategy("mention", F.col("k") / 100.0), Strategy("guess", F.lit(0.3))]
    return verify(Tables(spark, d).events, ways).select("event_id", "strategy", "confidence", "verified")


@query("UDF-14", "SELECT event_type AS key, count(*) AS n FROM ev WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY 1 UNION ALL SELECT user_id::VARCHAR, count(*) FROM ev GROUP BY 1 HAVING count(*) >= 10")
def scheduled(spark: SparkSession, d: str) -> DataFrame:
    events = Tables(spark, d).events
    recent = run_job(spark, "count_since", {"since": "2024-01-15"}, events=events).select(F.col("event_type").alias("key"), "n")
    return recent.unionByName(run_job(spark, "busiest", {"least": 10}, events=events).select(F.col("user_id").cast("string").alias("key"), "n"))
