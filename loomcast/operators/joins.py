"""Joins of time-coded text: intervals, arrays, JSON, nearest and fuzzy matches.

Interval joins inside a key are made equi-joins on (key, bucket of time): each interval
is listed under the buckets that it touches, so a long episode spreads over tasks, and a
pair is counted in the bucket of its later start only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.operators.reliable import dealt


def semi(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return left.join(right, on, "left_semi")


def anti(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return left.join(right, on, "left_anti")


def anti_any_key(left: DataFrame, right: DataFrame, id_col: str, keys: Sequence[Column], right_key: str) -> DataFrame:
    """Rows of left none of whose keys is in right: an OR of equalities as one equi-join."""
    tried = left.select(id_col, F.explode(F.array_compact(F.array(*keys))).alias("__key"))
    hit = tried.join(right.select(F.col(right_key).alias("__key")), "__key", "left_semi").select(id_col).distinct()
    return left.join(hit, id_col, "left_anti")


def explode_lookup(left: DataFrame, array_col: str, right: DataFrame, right_key: str, key: str, value: str, out: str) -> DataFrame:
    """Adds out: the values of right for the members of left's array, in the array's order."""
    cells = left.select(key, F.posexplode(array_col).alias("__at", right_key))
    found = cells.join(right.select(right_key, value), right_key)
    held = found.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("__at", value))).alias("__found"))
    return left.join(held.select(key, F.col(f"__found.{value}").alias(out)), key, "left")


#: Pairs that co_appearance expects of a row, when it deals them to tasks.
PAIRS_A_ROW = 4


def co_appearance(df: DataFrame, group: str, member: str) -> DataFrame:
    """(a, b, together): pairs of members by the number of groups that hold both.

    Rows and pairs are dealt to tasks whose number grows with the rows.
    """
    rows = df.select(group, member).where(F.col(member).isNotNull() & F.col(group).isNotNull())
    n = rows.count()
    once = dealt(rows, n, group).distinct()
    pairs = once.withColumnRenamed(member, "a").join(once.withColumnRenamed(member, "b"), group).where("a < b").select("a", "b")
    return dealt(pairs, PAIRS_A_ROW * n, "a", "b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("together"))


def _in_buckets(df: DataFrame, start: str, end: str, width: float, pad: float = 0.0) -> DataFrame:
    low, high = F.floor((F.col(start) - pad) / width), F.floor((F.col(end) + pad) / width)
    return df.withColumn("__bucket", F.explode(F.sequence(low, high)))


def interval_overlaps(left: DataFrame, right: DataFrame, key: str, a: tuple[str, str], b: tuple[str, str], width: float = 60.0) -> DataFrame:
    """Inner join on key of intervals that share time, with overlap (their common length).

    a and b name start and end of left and right; other column names must differ.
    """
    r = right.withColumnRenamed(key, "__key")
    joined = _in_buckets(left, *a, width).join(_in_buckets(r, *b, width).withColumnRenamed("__bucket", "__other"), (F.col(key) == F.col("__key")) & (F.col("__bucket") == F.col("__other")))
    start, end = F.greatest(a[0], b[0]), F.least(a[1], b[1])
    once = F.col("__bucket") == F.floor(start / width)
    return joined.where((end > start) & once).withColumn("overlap", end - start).drop("__key", "__bucket", "__other")


def best_overlap(left: DataFrame, right: DataFrame, key: str, left_id: str, a: tuple[str, str], b: tuple[str, str], label: str, width: float = 60.0) -> DataFrame:
    """(left_id, label, overlap): for each left interval, the label with most common time (ties: the least label)."""
    pairs = interval_overlaps(left, right, key, a, b, width)
    sums = pairs.groupBy(left_id, label).agg(F.sum("overlap").alias("overlap"))
    return sums.groupBy(left_id).agg(F.min(F.struct((-F.col("overlap")).alias("o"), label)).alias("m")).select(left_id, F.col(f"m.{label}").alias(label), (-F.col("m.o")).alias("overlap"))


def overlap_else_nearest(words: DataFrame, spans: DataFrame, key: str, word_id: str, a: tuple[str, str], b: tuple[str, str], label: str, width: float = 60.0) -> DataFrame:
    """(word_id, label, confidence): the span with most overlap at 0.8, else the nearest by edge at max(0.3, 0.8 - distance / 10).

    Distance runs from the word's midpoint to the nearer edge. The nearest span before
    and after comes from a sort of words and spans together, not from pairs.
    """
    hit = best_overlap(words, spans, key, word_id, a, b, label, width).select(word_id, label, F.lit(0.8).alias("confidence"))
    rest = words.join(hit.select(word_id), word_id, "left_anti").select(F.col(key), F.col(word_id), ((F.col(a[0]) + F.col(a[1])) / 2).alias("at"))
    from pyspark.sql import Window

    ends = spans.select(key, F.col(b[1]).alias("at"), F.struct(F.col(b[1]).alias("edge"), F.col(label)).alias("left"), F.lit(None).cast(f"struct<edge:double,{label}:{spans.schema[label].dataType.simpleString()}>").alias("right"))
    starts = spans.select(key, F.col(b[0]).alias("at"), F.lit(None).cast(ends.schema["left"].dataType).alias("left"), F.struct(F.col(b[0]).alias("edge"), F.col(label)).alias("right"))
    marks = rest.select(key, word_id, "at").unionByName(ends.unionByName(starts), allowMissingColumns=True)
    back, ahead = Window.partitionBy(key).orderBy("at"), Window.partitionBy(key).orderBy(F.col("at").desc())
    near = marks.withColumns({"before": F.last("left", True).over(back), "after": F.last("right", True).over(ahead)}).where(F.col(word_id).isNotNull())
    gap_b, gap_a = F.abs(F.col("at") - F.col("before.edge")), F.abs(F.col("after.edge") - F.col("at"))
    first = F.col("after").isNull() | (gap_b <= gap_a)
    picked = near.select(word_id, F.when(first, F.col(f"before.{label}")).otherwise(F.col(f"after.{label}")).alias(label), F.when(first, gap_b).otherwise(gap_a).alias("d"))
    return hit.unionByName(picked.where(F.col(label).isNotNull()).select(word_id, label, F.greatest(F.lit(0.3), 0.8 - F.col("d") / 10).alias("confidence")))


def context_window(targets: DataFrame, others: DataFrame, key: str, a: tuple[str, str], b: tuple[str, str], seconds: float, width: float = 60.0) -> DataFrame:
    """Inner join of targets with what lies within seconds before their start or after their end."""
    wide = targets.withColumns({"__from": F.col(a[0]) - seconds, "__to": F.col(a[1]) + seconds})
    r = others.withColumnRenamed(key, "__key")
    joined = _in_buckets(wide, "__from", "__to", width).join(_in_buckets(r, *b, width).withColumnRenamed("__bucket", "__other"), (F.col(key) == F.col("__key")) & (F.col("__bucket") == F.col("__other")))
    once = F.col("__bucket") == F.floor(F.greatest("__from", b[0]) / width)
    return joined.where((F.col(b[0]) <= F.col("__to")) & (F.col(b[1]) >= F.col("__from")) & once).drop("__key", "__bucket", "__other", "__from", "__to")


def coverage(spans: DataFrame, cover: DataFrame, key: str, span_id: str, a: tuple[str, str], b: tuple[str, str], width: float = 60.0) -> DataFrame:
    """spans with covered (summed overlaps, not de-duplicated) and ratio (0 for empty spans)."""
    sums = interval_overlaps(spans, cover, key, a, b, width).groupBy(span_id).agg(F.sum("overlap").alias("covered"))
    length = F.col(a[1]) - F.col(a[0])
    return spans.join(sums, span_id, "left").withColumn("covered", F.coalesce("covered", F.lit(0.0))).withColumn("ratio", F.when(length > 0, F.col("covered") / length).otherwise(0.0))


def expand_by(spans: DataFrame, others: DataFrame, key: str, span_id: str, a: tuple[str, str], b: tuple[str, str], most: float, width: float = 60.0) -> DataFrame:
    """spans with new_start and new_end: stretched over the intervals that overlap them, by `most` at each end."""
    hit = interval_overlaps(spans, others, key, a, b, width).groupBy(span_id).agg(F.min(b[0]).alias("__s"), F.max(b[1]).alias("__e"))
    out = spans.join(hit, span_id, "left")
    return out.withColumns({
        "new_start": F.greatest(F.least(F.coalesce("__s", a[0]), a[0]), F.col(a[0]) - most),
        "new_end": F.least(F.greatest(F.coalesce("__e", a[1]), a[1]), F.col(a[1]) + most),
    }).drop("__s", "__e")


def remap_times(points: DataFrame, mapping: DataFrame, key: str, at: str, out: str = "mapped", width: float = 60.0) -> DataFrame:
    """points with out: the time moved by the last interval (from_start, from_end, to_start, ordinal) that holds it, else as it is.

    Points meet the intervals of their own bucket of time only.
    """
    held = _in_buckets(mapping, "from_start", "from_end", width)
    tried = points.select(key, at).distinct().withColumn("__bucket", F.floor(F.col(at) / width))
    hit = tried.join(held, [key, "__bucket"]).where((F.col(at) >= F.col("from_start")) & (F.col(at) <= F.col("from_end")))
    moved = hit.groupBy(key, at).agg(F.max_by(F.col("to_start") + F.col(at) - F.col("from_start"), "ordinal").alias("__m"))
    return points.join(moved, [key, at], "left").withColumn(out, F.coalesce("__m", at)).drop("__m")


def concatenated(spans: DataFrame, key: str, start: str, end: str, ordinal: str) -> DataFrame:
    """The mapping for remap_times from the times of a key's spans laid end to end, in order, back to their own."""
    from pyspark.sql import Window

    before = Window.partitionBy(key).orderBy(start, ordinal).rowsBetween(Window.unboundedPreceding, -1)
    placed = spans.withColumn("from_start", F.coalesce(F.sum(F.col(end) - F.col(start)).over(before), F.lit(0.0)))
    return placed.select(key, "from_start", (F.col("from_start") + F.col(end) - F.col(start)).alias("from_end"), F.col(start).alias("to_start"), F.col("from_start").alias("ordinal"))


def day_window(left: DataFrame, right: DataFrame, left_at: str, right_at: str, days: int, extra: Column) -> DataFrame:
    """Inner join of rows within `days` of each other and extra holding, as an equi-join on days."""
    l = left.withColumn("__day", F.explode(F.sequence(F.date_sub(F.to_date(left_at), days), F.date_add(F.to_date(left_at), days))))  # noqa: E741
    r = right.withColumn("__day", F.to_date(right_at))
    near = F.abs(F.unix_timestamp(left_at) - F.unix_timestamp(right_at)) <= days * 86400
    return l.join(r, "__day").where(near & extra).drop("__day")


def set_match(left: DataFrame, right: DataFrame, left_id: str, right_id: str, member: str) -> DataFrame:
    """(left_id, right_id, shared, overlap, coverage): members shared, over the left's and the right's number."""
    l, r = left.select(left_id, member).distinct(), right.select(right_id, member).distinct()  # noqa: E741
    ln, rn = l.groupBy(left_id).agg(F.count(F.lit(1)).alias("__l")), r.groupBy(right_id).agg(F.count(F.lit(1)).alias("__r"))
    both = l.join(r, member).groupBy(left_id, right_id).agg(F.count(F.lit(1)).alias("shared")).join(ln, left_id).join(rn, right_id)
    return both.select(left_id, right_id, "shared", (F.col("shared") / F.col("__l")).alias("overlap"), (F.col("shared") / F.col("__r")).alias("coverage"))
