"""Readers of the formats that episodes come in."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCES = T.StructType([T.StructField(n, T.StringType()) for n in ("name", "platform", "url", "project")])
TRANSCRIPT = "content_id string, chunk_index int, segments array<struct<start:double,end:double,text:string>>"


def window_table(spark: SparkSession, paths: dict[int, str], days: int) -> DataFrame:
    """The smallest window table that covers days (the largest there is if none does)."""
    fit = min((n for n in paths if n >= days), default=max(paths))
    return spark.read.parquet(paths[fit])


def csv_sources(spark: SparkSession, path: str, schema: T.StructType = SOURCES) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)


def csv_themes(spark: SparkSession, path: str) -> DataFrame:
    """(theme_id, theme, subthemes) of a CSV of (theme_id, theme, subtheme_id, subtheme)."""
    rows = spark.read.csv(path, header=True, schema="theme_id string, theme string, subtheme_id string, subtheme string")
    return rows.groupBy("theme_id").agg(F.min("theme").alias("theme"), F.sort_array(F.collect_set(F.when(F.col("subtheme_id").isNotNull(), F.struct("subtheme_id", "subtheme")))).alias("subthemes"))


def new_sources(candidates: DataFrame, known: Iterable[DataFrame], key: str = "url") -> DataFrame:
    """Candidates whose normalised key no known list has."""
    bare = F.lower(F.regexp_replace(F.trim(key), "/+$", ""))
    for df in known:
        candidates = candidates.withColumn("__key", bare).join(df.select(bare.alias("__key")), "__key", "left_anti").drop("__key")
    return candidates


def feed_items(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Feed or channel listings that a downloader has landed as JSON lines, plain or gzip."""
    return spark.read.schema(schema).json(path)


def transcripts(spark: SparkSession, path: str) -> DataFrame:
    """(content_id, chunk_index, start, end, text) of JSON transcripts, plain or gzip: a document or an array of documents a file."""
    rows = spark.read.schema(TRANSCRIPT).option("multiLine", True).json(path)
    return rows.select("content_id", "chunk_index", F.inline("segments"))


def discover(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(path, content_id, chunk) of the files under a prefix whose path matches pattern with those two groups."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    return files.where(F.col("path").rlike(pattern)).select("path", F.regexp_extract("path", pattern, 1).alias("content_id"), F.regexp_extract("path", pattern, 2).cast("int").alias("chunk"))


def seconds(stamp: Column) -> Column:
    """hh:mm:ss.mmm or mm:ss.mmm as seconds."""
    return F.aggregate(F.split(F.regexp_replace(stamp, ",", "."), ":"), F.lit(0.0), lambda s, x: s * 60 + x.cast("double"))


def subtitle_cues(documents: DataFrame, key: str, whole: str) -> DataFrame:
    """(key, n, start, end, text) of WebVTT documents, one a row; tags are dropped and lines joined."""
    cue = r"(?s)((?:\d+:)?\d{2}:\d{2}[.,]\d{3}) --> ((?:\d+:)?\d{2}:\d{2}[.,]\d{3})[^\n]*\n(.*?)(?=\n\s*\n|\z)"
    cues = documents.select(key, F.posexplode(F.arrays_zip(*[F.regexp_extract_all(F.col(whole), F.lit(cue), F.lit(i)).alias(n) for i, n in ((1, "a"), (2, "b"), (3, "t"))])).alias("n", "c"))
    text = F.trim(F.regexp_replace(F.regexp_replace("c.t", r"<[^>]*>", ""), r"\s+", " "))
    return cues.select(key, "n", seconds(F.col("c.a")).alias("start"), seconds(F.col("c.b")).alias("end"), text.alias("text"))


def subtitles(spark: SparkSession, path: str) -> DataFrame:
    """(path, n, start, end, text) of WebVTT files."""
    return subtitle_cues(spark.read.text(path, wholetext=True).withColumn("path", F.input_file_name()), "path", "value")


def aliases(spark: SparkSession, path: str) -> DataFrame:
    """(alias, name) of a simple YAML mapping of names to lists: `name:` lines and `- alias` lines below each."""
    whole = spark.read.text(path, wholetext=True).select(F.concat(F.lit("\n"), "value").alias("value"))
    # A file is parted before each name's line, so that its lines are looked at once; what stands before the first has no name.
    heads = F.split("value", r"\n(?=[^\s#:-][^:\n]*:\s*(?:\n|$))")
    blocks = whole.select(F.posexplode(heads).alias("at", "block")).select("at", F.split("block", "\n").alias("lines"))
    name = F.when(F.col("at") > 0, F.regexp_extract(F.col("lines")[0], r"^([^\s#:-][^:]*):\s*$", 1))
    alias = lambda line: F.trim(F.regexp_replace(F.regexp_extract(line, r"^\s*-\s*(.+?)\s*$", 1), "[\"']", ""))
    said = blocks.select(F.explode(F.filter(F.transform("lines", alias), lambda x: x != "")).alias("alias"), name.alias("name"))
    return said.select("alias", "name")


def chart_rows(pages: DataFrame, html: str, row: str) -> DataFrame:
    """(the page's columns, rank, name, creator) of chart pages; row is a pattern with those three groups."""
    found = [F.regexp_extract_all(F.col(html), F.lit(row), F.lit(i)).alias(n) for i, n in ((1, "rank"), (2, "name"), (3, "creator"))]
    return pages.withColumn("__row", F.explode(F.arrays_zip(*found))).select(*[c for c in pages.columns if c != html], F.col("__row.rank").try_cast("int").alias("rank"), "__row.name", "__row.creator")


def keep(df: DataFrame, path: str) -> DataFrame:
    """df materialised as Parquet under path, read back: a cache that outlives the session."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def cached(spark: SparkSession, path: str, key: str, build: Callable[[], DataFrame], as_of: float, ttl_s: float) -> DataFrame:
    """The table kept under key, if one was built within ttl_s before as_of (in seconds); else build()'s, which is kept.

    Each build is a folder of its own, named by its time, so that readers of the one before are left alone.
    """
    place = f"{path}/{hashlib.blake2b(key.encode(), digest_size=8).hexdigest()}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    times = [float(f.getPath().getName().removeprefix("at=")) for f in system.listStatus(where)] if system.exists(where) else []
    young = [t for t in times if as_of - ttl_s <= t <= as_of]
    if young:
        return spark.read.parquet(f"{place}/at={max(young)}")
    return keep(build(), f"{place}/at={as_of}")
