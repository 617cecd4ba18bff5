"""From raw documents to packed training sequences: five operators of loomcast.llm in a row.

Each stage reads all that its predecessor kept; all but the last return the columns of
documents. run() writes each stage's result as Parquet to the shared checkpoint folder
and goes on from there, so that a lost executor costs one stage's work at most.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.llm import exact_dedup, near_dedup, packing, pii, quality
from loomcast.llm.common import documents, ensure_checkpoint_dir, free_name, remove_folder, tokenizer_file
from loomcast.llm.queries import quality_model


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    A null text is scored as an empty one; rows of null or repeated ids are scored each by
    its own text, and very long texts whole. Without labels all stay; an empty table stays
    empty; the columns stay, whatever their names.
    """
    return quality.accepted(docs, quality_model(spark, sf_dir, docs))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each normalised text: the row with the smallest id.

    Null texts equal empty ones. Rows without an id stay only where their text has no row
    with one; of rows that share text and id one stays. The columns stay, whatever their
    names; an empty table stays empty.
    """
    return exact_dedup.deduplicated(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word similarity of 0.8 or more: the row with the smallest id.

    SimHash fingerprints by Golay keys and MinHash bands propose pairs; true similarity of
    the whole texts links them. Texts without words are one group. Null and repeated ids
    are treated as in without_copies.
    """
    return near_dedup.one_of_each(docs, width=5, similarity=0.8)


def pseudonymous(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and secrets replaced under the session's key; n_chars follows a changed text.

    Null texts stay null; every row stays, in its columns, whatever their names.
    """
    found = free_name("found", docs.columns)
    safe = pii.protect(docs, pii.session_key(spark), counts_col=found)
    changed = F.when(F.size(found) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return safe.withColumn("n_chars", changed).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences of 2048 tokens; a null or empty text is a piece of the end mark alone."""
    return packing.pack(packing.pieces(docs, tokenizer_file("word_bpe_49k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_quality),
    ("exact dedup", without_copies),
    ("simhash near-dedup", without_near_copies),
    ("pii", pseudonymous),
    ("best-fit packing", packed),
]

#: SQL can't express the classifier, the near copies' groups, the pseudonyms or the packing; tests/llm has a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, from Parquet; a stage's folder goes when the next one is written."""
    ensure_checkpoint_dir(spark)
    place = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{k}")
        docs = spark.read.parquet(f"{place}/{k}")
        if k:
            remove_folder(spark, f"{place}/{k - 1}")
    return docs


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
