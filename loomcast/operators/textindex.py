"""Full-text search over an inverted index: posting lists with positions, kept by term bucket.

The index is a folder of Parquet files, `bucket=...` by a hash of the term and sorted by
term within, so that a question's scan opens its terms' buckets only and skips row groups
by their statistics. A posting has its document's length; one row of totals stands beside.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.operators.windows import top_per_group

BUCKETS = 64
#: Shares of the ids, each a file in a bucket.
SHARES = 8
#: Words whose postings are put together at once (a text is never divided).
WORDS_AT_ONCE = 1 << 19
#: Of so many terms at most the questions go to every task; more meet the postings by term.
TERMS_AT_ONCE = 1 << 16
#: Saturation of a term's frequency and share of the length's correction, as in Okapi BM25.
K1, B = 1.2, 0.75
_TERM = r"[\p{L}\p{N}_]+"


def bucket_of(term: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def packed_postings(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(term, at): where documents have their words, a row for each word of some texts together; at: array of (id, length, positions).

    Words are runs of letters, digits and underscores, letter case aside; positions count
    from 0. Texts count whole; null and empty ones have none.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(ids: pa.Array, words: list[str], of: list[int], n: list[int]) -> pa.RecordBatch:
        """Of the words of texts one after the other; of names the ids' places, n their numbers of words."""
        of, n = np.array(of, np.int64), np.array(n, np.int64)
        terms = pa.array(words, pa.string()).dictionary_encode()
        code = np.asarray(terms.indices, np.int64) << 32 | np.repeat(np.arange(len(n)), n)
        order = np.argsort(code, kind="stable")
        code = code[order]
        places = (np.arange(len(code)) - np.repeat(np.cumsum(n) - n, n))[order].astype(np.int32)

        def starts(x: np.ndarray) -> np.ndarray:
            return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)

        first = starts(code)
        text, term = code[first] & 0xFFFFFFFF, code[first] >> 32
        spots = pa.ListArray.from_arrays(pa.array(np.append(first, len(code)), pa.int32()), pa.array(places))
        each = pa.StructArray.from_arrays([ids.take(pa.array(of[text])), pa.array(n[text], pa.int32()), spots], names=["id", "length", "positions"])
        heads = starts(term)
        return pa.RecordBatch.from_arrays([terms.dictionary.take(pa.array(term[heads])), pa.ListArray.from_arrays(pa.array(np.append(heads, len(term)), pa.int32()), each)], names=["term", "at"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find = regex.compile(_TERM).findall
        for batch in batches:
            words, of, n = [], [], []
            for row in range(batch.num_rows):  # a text at a time, as one may be very long
                said = find(batch.column(1)[row].as_py() or "")
                words += said
                of.append(row)
                n.append(len(said))
                if len(words) >= WORDS_AT_ONCE:
                    yield rows(batch.column(0), words, of, n)
                    words, of, n = [], [], []
            yield rows(batch.column(0), words, of, n)

    return docs.select(id_col, F.lower(text_col).alias("text")).mapInArrow(run, f"term string, at array<struct<id:{kind},length:int,positions:array<int>>>")


def postings(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(term, id, length, positions): packed_postings with a row for each document and word."""
    return packed_postings(docs, id_col, text_col).select("term", F.inline("at"))


def write_index(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> None:
    """Write the index of docs, ids unique, to folder/postings and folder/totals.

    Packed rows are dealt by bucket and a share of their first ids, so that the postings of
    a word that stands in every document are written by several tasks; by hashes, as ranges
    would have all postings made twice, once for a sample.
    """
    rows = packed_postings(docs, id_col, text_col).withColumn("bucket", bucket_of(F.col("term"), buckets))
    rows.repartition("bucket", F.pmod(F.xxhash64(F.col("at")[0]["id"]), F.lit(SHARES))).sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{folder}/postings")
    size = F.size(F.expr(f"regexp_extract_all(lower({text_col}), '{_TERM.replace(chr(92), chr(92) * 2)}', 0)"))
    docs.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("words")).write.parquet(f"{folder}/totals")


def read_postings(spark: SparkSession, folder: str, terms: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The postings of terms (term), a stated set: other buckets' files aren't opened."""
    wanted = terms.select("term").distinct().withColumn("bucket", bucket_of(F.col("term"), buckets))
    some = sorted(r.bucket for r in wanted.select("bucket").distinct().collect())  # at most as many as there are buckets
    rows = spark.read.parquet(f"{folder}/postings").where(F.col("bucket").isin(some) if some else F.lit(False))
    return rows.join(wanted, ["bucket", "term"], "left_semi").select("bucket", "term", F.inline("at"))


def _spot(position: Column, number: Column) -> Column:
    """A place and the number of the term there, as one number that sorts by place."""
    return F.shiftleft(position.cast("long"), 31).bitwiseOR(number.cast("long"))


def closeness(occurrences: Column) -> Column:
    """Sum of 1 / gap^2 over neighbouring occurrences of different terms; occurrences: array of _spot(position, term's number)."""
    start = F.struct(F.lit(None).cast("long").alias("p"), F.lit(None).cast("long").alias("t"), F.lit(0.0).alias("s"))

    def step(acc: Column, x: Column) -> Column:
        position, term = F.shiftright(x, 31), x.bitwiseAND(F.lit((1 << 31) - 1))
        gap = (position - acc["p"]).cast("double")
        return F.struct(position.alias("p"), term.alias("t"), (acc["s"] + F.when(acc["t"] != term, 1 / (gap * gap)).otherwise(0.0)).alias("s"))

    return F.aggregate(F.sort_array(occurrences), start, step, lambda acc: acc["s"])


def search_index(spark: SparkSession, folder: str, questions: DataFrame, every: bool = False, limit: int | None = None, exclude: DataFrame | None = None, id_col: str = "doc_id", buckets: int = BUCKETS) -> DataFrame:
    """(query_id, id, rank) of the documents that match questions (query_id, terms): with every, all of a question's terms, else any.

    rank is the terms' weighted frequencies (BM25) and the closeness of their positions;
    limit keeps the best of each question, equal ranks by id. exclude (id) leaves out documents.
    """
    asked = questions.select("query_id", F.posexplode(F.array_distinct(F.transform("terms", F.lower))).alias("number", "term"))
    sizes = asked.groupBy("query_id").agg(F.count(F.lit(1)).alias("terms"))
    found = read_postings(spark, folder, asked, buckets)
    rarity = found.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    named = asked.join(rarity, "term")
    if asked.count() <= TERMS_AT_ONCE:  # a frequent word's postings stay where they are read, instead of all in one task
        named = F.broadcast(named)
    totals = spark.read.parquet(f"{folder}/totals")
    if exclude is not None:
        found = found.join(exclude.select(F.col(id_col).alias("id")), "id", "left_anti")
    tf, df, docs = F.size("positions"), F.col("df"), F.col("docs")
    idf = F.log(1 + (docs - df + 0.5) / (df + 0.5))
    weight = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("length") * docs / F.col("words")))
    each = found.join(named, "term").crossJoin(F.broadcast(totals)).select("query_id", "number", "id", "positions", weight.alias("weight"))
    spots = F.transform("positions", lambda p: _spot(p, F.col("number")))
    met = each.select("query_id", "id", "weight", spots.alias("spots")).groupBy("query_id", "id").agg(F.sum("weight").alias("w"), F.count(F.lit(1)).alias("n"), F.flatten(F.collect_list("spots")).alias("spots"))
    met = met.join(sizes, "query_id").where(F.col("n") == F.col("terms")) if every else met
    out = met.select("query_id", F.col("id").alias(id_col), F.round(F.col("w") + closeness(F.col("spots")), 6).alias("rank"))
    return out if limit is None else top_per_group(out, ["query_id"], [F.col("rank").desc(), F.col(id_col)], limit)
