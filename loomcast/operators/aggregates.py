"""Distributions, concentration, temporal buckets and other statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcast.functions.scores import bands


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def sum_where(value: Column, condition: Column) -> Column:
    return F.sum(F.when(condition, value))


def distribution(df: DataFrame, column: str, k: int, first_seen: str | None = None, order: Column | None = None) -> DataFrame:
    """The k most frequent values with count and percentage of all rows; ties by first_seen, else by value."""
    groups = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"), *([F.min(first_seen).alias("__first")] if first_seen else []))
    total = df.agg(F.count(F.lit(1)).alias("__all"))  # one row
    tie = [F.col("__first")] if first_seen else [F.col(column).asc_nulls_last()]
    kept = groups.orderBy(F.col("n").desc(), *tie).limit(k)
    return kept.crossJoin(F.broadcast(total)).select(column, "n", (100.0 * F.col("n") / F.col("__all")).alias("percentage"))


def sunday_week(at: Column) -> Column:
    """Week of the year that starts on Sunday, from 0."""
    return F.floor((F.dayofyear(at) - 1 + 7 - (F.dayofweek(at) - 1)) / 7)


def temporal_buckets(df: DataFrame, at: str) -> DataFrame:
    """(bucket, n): days for spans of up to 14 days, Sunday weeks up to 90, else months."""
    span = df.agg(F.datediff(F.max(at), F.min(at)).alias("__span"))  # one row
    day, month = F.date_format(at, "yyyy-MM-dd"), F.date_format(at, "yyyy-MM")
    week = F.concat(F.date_format(at, "yyyy"), F.lit("-W"), F.lpad(sunday_week(F.col(at)).cast("string"), 2, "0"))
    bucket = F.when(F.col("__span") <= 14, day).when(F.col("__span") <= 90, week).otherwise(month)
    return df.crossJoin(F.broadcast(span)).groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def concentration(df: DataFrame, column: str) -> DataFrame:
    """One row: n_groups, hhi (sum of squared percentages), top3 and top10 shares in percent, level.

    Works on the counts of the groups; only the ten largest are ordered.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    sums = counts.agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("n_groups"), F.sum(F.col("n").cast("double") * F.col("n")).alias("squares"))
    largest = counts.orderBy(F.col("n").desc(), F.col(column)).limit(10).withColumn("r", F.row_number().over(Window.orderBy(F.col("n").desc(), F.col(column))))
    tops = largest.agg(F.sum(F.when(F.col("r") <= 3, F.col("n"))).alias("t3"), F.sum("n").alias("t10"))
    hhi = F.col("squares") / (F.col("all") * F.col("all")) * 10000
    share = lambda c: 100.0 * F.col(c) / F.col("all")
    return sums.crossJoin(tops).select("n_groups", hhi.alias("hhi"), share("t3").alias("top3_share"), share("t10").alias("top10_share"), bands(hhi, [(1500, "moderate"), (2500, "high")], "low").alias("level"))


def centrality_level(coverage_percent: Column) -> Column:
    return bands(coverage_percent, [(1, 1), (5, 2), (15, 3), (30, 4), (50, 5)], 0)


def pivot_share(df: DataFrame, key: str, column: str, values: Sequence[str], amount: str) -> DataFrame:
    """Sums of amount by value side by side, each with its percentage of the key's total (of 1.0 where that is missing)."""
    wide = df.groupBy(key).pivot(column, list(values)).agg(F.sum(amount))
    total = df.groupBy(key).agg(F.sum(amount).alias("total"))
    out = wide.join(total, key, "left")
    whole = F.when(F.coalesce("total", F.lit(0.0)) == 0, 1.0).otherwise(F.col("total"))
    return out.select(key, *[F.coalesce(F.col(v), F.lit(0.0)).alias(v) for v in values], *[(100 * F.coalesce(F.col(v), F.lit(0.0)) / whole).alias(f"{v}_pct") for v in values])


def gap_days(source: DataFrame, cache: DataFrame, source_at: str, cache_at: str, share: float = 0.9) -> DataFrame:
    """(day, n_source, n_cache): days of which the cache holds under share of the source's rows."""
    s = source.groupBy(F.to_date(source_at).alias("day")).agg(F.count(F.lit(1)).alias("n_source"))
    c = cache.groupBy(F.to_date(cache_at).alias("day")).agg(F.count(F.lit(1)).alias("n_cache"))
    held = F.coalesce("n_cache", F.lit(0))
    return s.join(c, "day", "left").select("day", "n_source", held.alias("n_cache")).where(F.col("n_cache") < F.col("n_source") * share)


def importance(df: DataFrame, key: str, rankings: str, as_of_month: str, platform_weight: Mapping[str, float], decay: float = 0.9, digits: int = 2) -> DataFrame:
    """(key, importance) from month -> (platform:country -> rank): the best weighted, decayed rank of each chart, summed.

    A rank r gives 101 - r points (at least 0); months that don't parse are left out.
    """
    months = df.select(key, F.explode(rankings).alias("month", "charts")).select(key, "month", F.explode("charts").alias("chart", "rank"))
    then, now = F.try_to_date(F.concat("month", F.lit("-01")), "yyyy-MM-dd"), F.to_date(F.lit(as_of_month + "-01"))
    age = F.months_between(now, then)
    pairs = F.create_map(*[x for p, w in platform_weight.items() for x in (F.lit(p), F.lit(w))])
    weight = F.coalesce(F.try_element_at(pairs, F.substring_index("chart", ":", 1)), F.lit(1.0))
    points = F.greatest(F.lit(0.0), F.lit(101.0) - F.col("rank")) * weight * F.pow(F.lit(decay), age)
    best = months.withColumn("p", points).where(then.isNotNull()).groupBy(key, "chart").agg(F.max("p").alias("p"))
    return best.groupBy(key).agg(F.round(F.sum("p"), digits).alias("importance"))
