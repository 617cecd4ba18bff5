"""Exact deduplication by skew-safe combining, DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import ASCII_SPACE, cut, spread_join, stay

SALTS = 16


def normalised(text_col: str) -> F.Column:
    """Null as empty; each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), ASCII_SPACE, " ")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("text"))
    return rows.select("id", "text", F.unhex(F.sha2("text", 256)).alias("digest"))


def text_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per distinct normalised text: digest, text, keep_id, group_size; dealt out by digest.

    Rows are keyed by digest and full content at each of three stages: the map side of
    the first aggregation deduplicates each partition, its reduce side merges groups
    salted by partition (a hot text meets in many tasks, each with at most one row a
    partition), and the second aggregation combines the salts' winners, at most `salts`
    rows a text.
    """
    keyed = _rows(docs, id_col, text_col).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    salted = keyed.groupBy("digest", "text", "salt").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    return salted.repartition("digest").groupBy("digest", "text").agg(F.min("id").alias("keep_id"), F.sum("n").alias("group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256), one row per row of docs.

    keep_id is the smallest id among equal texts (null if all are null); kept marks the
    rows that have it. A null text equals an empty one; white space alone is one space,
    so it differs from empty. Repeated rows count in group_size and, having the same id,
    are all kept. Very long texts are compared whole, like others. An empty table gives an
    empty result; other columns are ignored, whatever their names.
    """
    groups = text_groups(docs, id_col, text_col, salts)
    by_digest = cut(groups.groupBy("digest").agg(F.count(F.lit(1)).alias("n_texts"), F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")))
    rows = _rows(docs, id_col, text_col)
    out = spread_join(rows.select("id", "digest"), by_digest.where("n_texts = 1").drop("n_texts"), ["digest"])
    clash = by_digest.where("n_texts > 1").select("digest")
    if not clash.isEmpty():  # different texts under one digest are told apart by content
        apart = groups.join(clash, "digest", "left_semi")
        out = out.unionByName(spread_join(rows, apart, ["digest", "text"]).select("digest", "id", "keep_id", "group_size"))
    return out.select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        F.coalesce(F.col("id") == F.col("keep_id"), F.lit(False)).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs for each normalised text, with all its columns: a row of the smallest id.

    Of rows that share text and smallest id one stays, of a text without any id one too.
    """
    def class_of(rows: DataFrame, name: str) -> DataFrame:
        return rows.withColumn(name, F.sha2(normalised(text_col), 256))

    found = exact_dedup(docs, id_col, text_col)
    marks = found.select(F.col(id_col).alias("id"), F.col("text_sha256").alias("cls"), F.col("text_sha256").alias("grp"), F.col("keep_id").alias("least"))
    return stay(docs, id_col, marks, class_of)
