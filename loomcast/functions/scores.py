"""Scores and signals of search, ranking and state machines, as Columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def days_between(as_of: Column, moment: Column) -> Column:
    """Whole days from moment to as_of, floored (negative for future moments)."""
    return F.floor((F.unix_timestamp(as_of) - F.unix_timestamp(moment)) / 86400)


def exponential_decay(age_days: Column, rate: float = 0.15, missing: float = 0.5) -> Column:
    return F.coalesce(F.exp(-rate * age_days), F.lit(missing))


def linear_recency(age_days: Column, window_days: int) -> Column:
    """1 now, 0 at the window's end; over 1 for future dates."""
    return F.greatest(F.lit(0.0), 1 - age_days / window_days)


def log_popularity(score: Column, most: Column) -> Column:
    """log1p of a non-negative score against that of the largest; 0 where there is none."""
    clean = F.greatest(F.coalesce(score, F.lit(0.0)), F.lit(0.0))
    return F.when(most > 0, F.least(F.lit(1.0), F.log1p(clean) / F.log1p(most))).otherwise(F.lit(0.0))


def log_popularity_fixed(score: Column, base: float = 101.0) -> Column:
    return F.log1p(F.greatest(F.coalesce(score, F.lit(0.0)), F.lit(0.0))) / F.log(F.lit(base))


def min_max(df: DataFrame, column: str, out: str, keys: Sequence[str] = ()) -> DataFrame:
    """Adds column scaled to 0..1 over each group of keys (over all rows without keys); 0.5 where all values are equal.

    Bounds are aggregated first: one row for all, which is broadcast, or one a group, which is joined.
    """
    bounds = df.groupBy(*keys).agg(F.min(column).alias("__low"), F.max(column).alias("__high"))
    joined = df.join(bounds, list(keys)) if keys else df.crossJoin(F.broadcast(bounds))
    scaled = F.when(F.col("__high") > F.col("__low"), (F.col(column) - F.col("__low")) / (F.col("__high") - F.col("__low"))).otherwise(F.when(F.col(column).isNotNull(), 0.5))
    return joined.withColumn(out, scaled).drop("__low", "__high")


def weighted(signals: Mapping[str, Column], weights: Mapping[str, float], scale: bool = True) -> Column:
    """Weighted sum of the signals that have a weight; weights add up to 1 if scale."""
    total = sum(weights[k] for k in signals if k in weights) or 1.0
    parts = [signals[k] * F.lit(weights[k] / (total if scale else 1.0)) for k in signals if k in weights]
    return sum(parts[1:], parts[0]) if parts else F.lit(0.0)


def bands(value: Column, steps: Sequence[tuple[float, object]], below) -> Column:
    """The label of the highest step that value reaches; steps ascend."""
    out = None
    for least, label in reversed(list(steps)):
        out = F.when(value >= least, F.lit(label)) if out is None else out.when(value >= least, F.lit(label))
    return F.lit(below) if out is None else out.otherwise(F.lit(below))


def state_from_flags(flags: Sequence[tuple[str, str]], blocked: str | None = None, start: str = "NEW") -> Column:
    """State of the last set flag of an ordered list (column, state); a blocked flag wins."""
    out = F.when(F.coalesce(F.col(blocked), F.lit(False)), F.lit("BLOCKED")) if blocked else None
    for column, state in reversed(list(flags)):
        cond = F.coalesce(F.col(column), F.lit(False))
        out = F.when(cond, F.lit(state)) if out is None else out.when(cond, F.lit(state))
    return F.lit(start) if out is None else out.otherwise(F.lit(start))


def bit_score(flags: Sequence[str]) -> Column:
    """1, 2, 4, ... for each set flag."""
    return sum((F.when(F.coalesce(F.col(f), F.lit(False)), 1 << i).otherwise(0) for i, f in enumerate(flags)), F.lit(0))


def cache_hours(days: Column) -> Column:
    return F.when(days <= 7, 6).when(days <= 30, 12).otherwise(24)


def sentiment_class(compound: Column, edge: float = 0.05) -> Column:
    return F.when(compound >= edge, "positive").when(compound <= -edge, "negative").otherwise("neutral")
