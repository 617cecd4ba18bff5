"""How far the sources of a language are from each other, and which terms set a source off, in exact arithmetic.

A term's share in a group is smoothed, so that every kept term of the language has a
price f in every pair of groups, also where neither has it: over all V terms the table
would be dense. It is never built. For two groups with supports A and B the sum over V
terms is taken apart by inclusion and exclusion:

* one-sided terms: f depends on the one group's count alone, as the other's is 0. A
  group's histogram (how many terms have each count) prices all of A at once, and all of B;
* terms of both: a join of the sparse postings by term corrects each by
  f(a, b) - f(a, 0) - f(0, b) + f(0, 0);
* all V - |A| - |B| others, those of both counted back by the correction: one constant, f(0, 0).

Work follows the occurring (group, term) rows, and the pairs of groups that meet in a term.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcast.llm.common import cut

#: Bytes of a term in UTF-8: letters, and whatever isn't ASCII.
_TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
SCALE = 1_000_000_000
#: Distinct (group, term) entries that a task adds up before it hands them on, and words of a text taken at once.
HELD, WORDS_AT_ONCE = 300_000, 100_000
#: Tasks among which a language's pairs of groups are dealt.
SALTS = 16


def _words(text: bytes) -> Iterator[list[bytes]]:
    low = text.lower()  # bytes: only A-Z are lowered
    if len(low) <= WORDS_AT_ONCE:
        if part := _TERM.findall(low):
            yield part
        return
    found = _TERM.finditer(low)
    while part := [m.group() for m in islice(found, WORDS_AT_ONCE)]:
        yield part


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in each group, and documents that hold it.

    Every group has one more row, whose term is null and n is 0, so that groups without
    terms stay. Null text, lang and source are empty; texts count whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def handed() -> pa.RecordBatch:
            sizes = np.array([len(held) + 1 for held in n.values()], np.int64)
            which = pa.array(np.repeat(np.arange(len(n)), sizes))
            lang, source = (pa.array([g[i] for g in n], pa.string()).take(which) for i in (0, 1))
            terms, counts, held_by = [], [], []
            for total, with_it in zip(n.values(), of.values(), strict=True):  # both have a group from its first document on
                terms += [*total, None]
                counts += [*total.values(), 0]
                held_by += [*map(with_it.__getitem__, total), 0]
            arrays = [lang, source, pa.array(terms, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()), pa.array(held_by, pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=["lang", "source", "term", "n", "docs"])

        n, of, size = defaultdict(Counter), defaultdict(Counter), 0
        for batch in batches:
            for lang, source, text in zip(*batch.columns, strict=True):
                group = (lang.as_py(), source.as_py())
                total, with_it, seen = n[group], of[group], set()
                size -= len(total)
                for words in _words(text.as_py()):
                    total.update(words)
                    seen.update(words)
                with_it.update(seen)
                size += len(total)
                if size >= HELD:
                    yield handed()
                    n, of, size = defaultdict(Counter), defaultdict(Counter), 0
        yield handed()

    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"))]
    raw = docs.select(*named, F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    each = raw.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return each.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE (n + 2) / (total + 2 terms)); decimals, as the product outgrows 64 bits."""
    return F.expr("1L") + F.call_function("div", (n.cast("decimal(18,0)") + 2) * F.lit(SCALE).cast("decimal(10,0)"), (total + 2 * terms).cast("decimal(19,0)"))


def price(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)) of two shares; both are at most SCALE + 1, so 64 bits hold it."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = 10, top_terms: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank): each group against the others of its language, and its outstanding terms.

    A language keeps the terms in at least min_docs of its documents. Part `pair`: item is
    another source of the language, value the summed price over all kept terms, all ranks.
    Part `term`: item is a kept term that the group has and whose share is larger than in
    the language, value its price against that, ranks to top_terms. Ranks count from 1,
    value descending, then item by its bytes.

    A null text, lang or source is empty; empty texts make a group without terms, which is
    in all pairs; very long texts count whole, repeated rows each. A language with one
    source has no pairs, one without kept terms pairs of value 0. An empty table gives an
    empty result; other columns are ignored, whatever their names.
    """
    counts = cut(term_counts(docs, lang_col, source_col, text_col))
    kept = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("d")).where(F.col("d") >= min_docs).drop("d")
    kept = cut(kept)
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n_lang").alias("total_lang"))
    found = counts.where("term is not null").drop("docs").join(kept, ["lang", "term"])
    sums = found.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("k"))
    groups = counts.where("term is null").select("lang", "source").join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.na.fill(0, ["total", "k", "v", "total_lang"])
    nothing = F.when(F.col("v") > 0, share(F.lit(0), F.col("total"), F.col("v"))).otherwise(F.lit(1))
    groups = cut(groups.withColumn("p0", nothing))
    sized = found.join(groups.select("lang", "source", "total", "p0", "v", "total_lang"), ["lang", "source"])
    found = cut(sized.select("lang", "source", "term", "n", "p0", share(F.col("n"), F.col("total"), F.col("v")).alias("p"), share(F.col("n_lang"), F.col("total_lang"), F.col("v")).alias("q")))

    sides = groups.select("lang", F.col("source").alias("a"), F.col("p0").alias("a0"), F.col("k").alias("ka"), "v", F.pmod(F.xxhash64("source"), F.lit(SALTS)).alias("salt"))
    others = groups.select("lang", F.col("source").alias("b"), F.col("p0").alias("b0"), F.col("k").alias("kb"), F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")).alias("salt"))
    pairs = cut(sides.join(others, ["lang", "salt"]).where("a <> b").drop("salt"))
    neither = pairs.select("lang", "a", "b", F.when(F.col("v") > 0, (F.col("v") - F.col("ka") - F.col("kb")) * price(F.col("a0"), F.col("b0"))).otherwise(F.lit(0)).alias("value"))
    histogram = found.groupBy("lang", F.col("source").alias("a"), "p").agg(F.count(F.lit(1)).alias("terms"))  # a count's share is the group's for all its terms
    one = pairs.join(histogram, ["lang", "a"]).groupBy("lang", "a", "b").agg(F.sum(F.col("terms") * price(F.col("p"), F.col("b0"))).alias("value"))
    left, right = (found.select("lang", "term", F.col("source").alias(x), F.col("p").alias(f"p{x}"), F.col("p0").alias(f"{x}0")) for x in "ab")
    pa_, pb, a0, b0 = (F.col(c) for c in ("pa", "pb", "a0", "b0"))
    both = left.join(right, ["lang", "term"]).where("a < b").groupBy("lang", "a", "b").agg(F.sum(price(pa_, pb) - price(pa_, b0) - price(a0, pb) + price(a0, b0)).alias("value"))
    turned = one.unionByName(both).select("lang", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("s"), "value").select("lang", "s.a", "s.b", "value")
    compared = neither.unionByName(turned).groupBy("lang", F.col("a").alias("source"), F.col("b").alias("item")).agg(F.sum("value").alias("value"))
    outstanding = found.where("p > q").select("lang", "source", F.col("term").alias("item"), price(F.col("p"), F.col("q")).alias("value"))

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    return ranked(compared, "pair").unionByName(ranked(outstanding, "term").where(F.col("rank") <= top_terms))
