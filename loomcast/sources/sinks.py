"""Sinks as new states: upserts, refreshes and exports that never change a table in place.

Each returns the state after the change as a DataFrame; write it to a new place, or
overwrite the partitions that changed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.operators.windows import top_per_group


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], keep_old: Sequence[str] = (), counters: Sequence[str] = ()) -> DataFrame:
    """Rows of both by keys. New values replace old ones, except keep_old (old unless null) and counters (added up)."""
    values = [c for c in old.columns if c not in keys]
    o = old.select(*keys, *[F.col(c).alias(f"__o_{c}") for c in values], F.lit(True).alias("__old"))
    n = new.select(*keys, *[F.col(c).alias(f"__n_{c}") for c in values], F.lit(True).alias("__new"))

    def pick(c: str) -> Column:
        a, b = F.col(f"__o_{c}"), F.col(f"__n_{c}")
        if c in counters:
            return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
        if c in keep_old:
            return F.coalesce(a, b)
        return F.when(F.col("__new"), b).otherwise(a)

    return o.join(n, list(keys), "full").select(*keys, *[pick(c).alias(c) for c in values])


def insert_new(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """old and the rows of new whose keys it lacks; of new rows with equal keys the first by order."""
    fresh = top_per_group(new, list(keys), list(order) or [F.lit(0)]) if order else new.dropDuplicates(list(keys))
    return old.unionByName(fresh.join(old, list(keys), "left_anti").select(old.columns))


def without(old: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    return old.join(gone, list(keys), "left_anti")


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], among: Column) -> DataFrame:
    """Rows outside among, and the first of each key inside it."""
    return df.where(~among).unionByName(top_per_group(df.where(among), keys, order).select(df.columns))


def refresh_window(cache: DataFrame, source: DataFrame, key: str, at: str, updated: str, as_of: str, days: int, fresh_hours: int, gap_share: float = 0.9) -> DataFrame:
    """A rolling window table after a refresh at as_of.

    Rows older than the window go; days of which the cache holds under gap_share of the
    source's rows are filled in; so are rows updated in the last fresh_hours. Rows that
    are there stay as they are. An exact share of gap_share is no gap.
    """
    now = F.lit(as_of).cast("timestamp")
    start = now - F.expr(f"INTERVAL {days} DAYS")
    kept = cache.where(F.col(at) >= start)
    wanted = source.where(F.col(at) >= start)
    have = kept.groupBy(F.to_date(at).alias("__day")).agg(F.count(F.lit(1)).alias("__c"))
    gaps = wanted.groupBy(F.to_date(at).alias("__day")).agg(F.count(F.lit(1)).alias("__s")).join(have, "__day", "left").where(F.coalesce("__c", F.lit(0)) < F.col("__s") * gap_share).select("__day", F.lit(True).alias("__gap"))
    marked = wanted.withColumn("__day", F.to_date(at)).join(gaps, "__day", "left")
    recent = F.col(updated) >= now - F.expr(f"INTERVAL {fresh_hours} HOURS")
    new = marked.where(F.coalesce("__gap", F.lit(False)) | recent).select(cache.columns)
    return kept.unionByName(new.join(kept, key, "left_anti").select(cache.columns))


def write_csv_gz(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path)


def write_json_gz(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "gzip").json(path)


def write_partitioned(df: DataFrame, path: str, by: str) -> None:
    """Overwrites only the partitions that df holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def nested_document(df: DataFrame, group: str, members: Sequence[str]) -> DataFrame:
    """(group, document): each group's rows as one JSON text, in the order of members."""
    rows = F.sort_array(F.collect_list(F.struct(*members)))
    return df.groupBy(group).agg(F.to_json(F.struct(F.count(F.lit(1)).alias("n"), rows.alias("rows"))).alias("document"))


def theme_dictionary(themes: DataFrame, theme_id: str, document: str) -> DataFrame:
    """(theme_id, theme, subtheme_id, subtheme) of nested theme documents {"name", "subthemes": {id: name}}; a theme without any has one row."""
    t = themes.select(F.col(theme_id).alias("theme_id"), F.from_json(document, "name string, subthemes map<string,string>").alias("d"))
    return t.select("theme_id", F.col("d.name").alias("theme"), F.explode_outer("d.subthemes").alias("subtheme_id", "subtheme"))


def write_yaml(df: DataFrame, path: str, name: str, values: str) -> None:
    """A YAML mapping of names to lists, as readers.aliases reads it: a few rows for people to look through."""
    quoted = F.transform(F.col(values).cast("array<string>"), lambda v: F.concat(F.lit("  - '"), F.replace(v, F.lit("'"), F.lit("''")), F.lit("'")))
    entry = F.concat_ws("\n", F.concat(F.col(name), F.lit(":")), F.array_join(quoted, "\n"))
    df.select(entry.alias("value")).write.mode("overwrite").text(path)


def event_text(df: DataFrame, kind: str) -> Column:
    """A server-sent event of each row: its kind and its other columns as JSON, with null for numbers that JSON lacks."""
    def plain(c: str) -> Column:
        number = df.schema[c].dataType.simpleString() in ("double", "float")
        lacking = F.isnan(c) | (F.abs(F.col(c)) == float("inf"))
        return (F.when(~lacking, F.col(c)) if number else F.col(c)).alias(c)

    data = F.to_json(F.struct(*[plain(c) for c in df.columns if c != kind]), {"ignoreNullFields": "false"})
    return F.concat(F.lit("event: "), F.col(kind), F.lit("\ndata: "), data)


def write_events(df: DataFrame, path: str, kind: str) -> None:
    df.select(event_text(df, kind).alias("value")).write.mode("overwrite").option("lineSep", "\n\n").text(path)
