"""Ranges held in arrays, and order-dependent cleaning of one episode's segments."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcast.operators.windows import top_per_group

RANGES = "array<struct<a:double,b:double>>"


def merge_ranges(ranges: Column, touch: float = 0.0) -> Column:
    """Overlapping ranges, and those at most touch apart, as one; array of (a, b) in order."""
    def step(acc: Column, r: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        joined = F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(last["a"].alias("a"), F.greatest(last["b"], r["b"]).alias("b"))))
        return F.when((F.size(acc) > 0) & (r["a"] <= last["b"] + touch), joined).otherwise(F.concat(acc, F.array(r)))

    return F.aggregate(F.array_sort(ranges.cast(RANGES)), F.array().cast(RANGES), step)


def valid_ranges(ranges: Column) -> Column:
    return F.filter(ranges.cast(RANGES), lambda r: r["a"].isNotNull() & r["b"].isNotNull() & (r["a"] >= 0) & (r["b"] > r["a"]))


def covered(ranges: Column, length: Column) -> Column:
    """Summed lengths over length; 0 where that is."""
    total = F.aggregate(ranges.cast(RANGES), F.lit(0.0), lambda s, r: s + r["b"] - r["a"])
    return F.when(length > 0, total / length).otherwise(0.0)


def chunk_count(total: Column, size: float, overlap: float, tail: float = 5.0) -> Column:
    """How many chunks chunk_plan makes of a positive total."""
    step = size - overlap
    count = F.greatest(F.lit(1), F.ceil((total - overlap) / step)).cast("int")
    return F.when((count > 1) & (total - (count - 1) * step < tail), count - 1).otherwise(count)


def chunk_rows(df: DataFrame, total: str, size: float, overlap: float, tail: float = 5.0) -> DataFrame:
    """df with chunk_plan as rows: i from 0, start, end; compiled, where an array's functions are called for each chunk. Rows without a positive total have none."""
    step = size - overlap
    held = df.where(F.col(total) > 0).withColumn("__last", chunk_count(F.col(total), size, overlap, tail) - 1)
    rows = held.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("__last"))))
    end = F.when(F.col("i") == F.col("__last"), F.col(total)).otherwise(F.least(F.col(total), F.col("i") * step + size))
    return rows.withColumns({"start": (F.col("i") * step).cast("double"), "end": end.cast("double")}).drop("__last")


def chunk_plan(total: Column, size: float, overlap: float, tail: float = 5.0) -> Column:
    """(start, end) of chunks of size with overlap; a last one shorter than tail joins the one before."""
    step = size - overlap
    last = chunk_count(total, size, overlap, tail)
    spots = F.transform(F.sequence(F.lit(0), last - 1), lambda i: F.struct((i * step).cast("double").alias("start"), F.when(i == last - 1, total).otherwise(F.least(total, i * step + size)).cast("double").alias("end")))
    return F.when(total > 0, spots).otherwise(F.array().cast("array<struct<start:double,end:double>>"))


def scan_groups(df: DataFrame, key: str, order: Sequence[Column | str], columns: Sequence[str], judge: Callable[[], Callable[..., bool | int]], out: str | None = None) -> DataFrame:
    """The rows that a rule keeps which looks at a group's rows in order; with out, all rows and the rule's number in that column.

    judge() starts a group and returns a function of the row's columns. Groups are laid
    side by side in sorted partitions and judged as a stream, so that small groups cost
    no call of their own and no group is held in memory but for what the rule remembers.
    """
    names = [key, *columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rule = object(), None
        for batch in batches:
            said = []
            for k, *row in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names], strict=True):
                if k != now:
                    now, rule = k, judge()
                said.append(rule(*row))
            if out is None:
                yield batch.filter(pa.array(said, pa.bool_()))
            else:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(said, pa.int64())], names=[*batch.schema.names, out])

    schema = df.schema if out is None else df.schema.add(out, "long")
    return df.repartition(key).sortWithinPartitions(key, *order).mapInArrow(run, schema)


class _Spans:
    """Spans found again by time: each lies in one or two slots of a grid as wide as its own length's power of two."""

    def __init__(self) -> None:
        self.grids: dict[float, dict[int, list[tuple[float, float]]]] = {}

    def add(self, a: float, b: float) -> None:
        width = 2.0 ** math.ceil(math.log2(max(b - a, 2.0**-10)))
        grid = self.grids.setdefault(width, {})
        for slot in {math.floor(a / width), math.floor(b / width)}:
            grid.setdefault(slot, []).append((a, b))

    def near(self, a: float, b: float) -> Iterator[tuple[float, float]]:
        """Every span that shares time with [a, b], and some others."""
        for width, grid in self.grids.items():
            low, high = math.floor(a / width), math.floor(b / width)
            for slot in range(low, high + 1) if high - low < len(grid) else [k for k in grid if low <= k <= high]:
                yield from grid.get(slot, ())


def drop_timing_copies(df: DataFrame, key: str, near: float = 0.05, share: float = 0.8) -> DataFrame:
    """Words (key, seg, idx, word, start, end) without copies: the same word with start and end near, or overlapping by share.

    Greedy in the order of (seg, idx) within a key; a word is compared with the kept ones
    of the same normalised word that lie near it in time.
    """

    def judge():
        held: dict[str, _Spans] = {}

        def fine(word: str, a: float, b: float) -> bool:
            spans = held.setdefault(re.sub(r"[^\w]", "", (word or "").lower()), _Spans())
            for x, y in spans.near(min(a, b) - near, max(a, b) + near):
                common = min(b, y) - max(a, x)
                if abs(a - x) <= near and abs(b - y) <= near or common > 0 and common >= share * max(1e-9, min(b - a, y - x)):
                    return False
            spans.add(a, b)
            return True

        return fine

    return scan_groups(df, key, ["seg", "idx"], ["word", "start", "end"], judge)


def drop_overlaps(df: DataFrame, key: str, share: float = 0.3, ties: Sequence[str] = ()) -> DataFrame:
    """Segments (key, start, end, ...) in order of start, end and ties, without those that overlap a kept one by over share of their length.

    The first kept segment that a segment meets decides. Kept ones that ended before the
    last start are forgotten: starts only grow, so nothing meets them again.
    """

    def judge():
        kept: list[tuple[float, float]] = []

        def fine(a: float, b: float) -> bool:
            kept[:] = [s for s in kept if s[1] > a]
            hit = next((min(b, y) - max(a, x) for x, y in kept if min(b, y) > max(a, x)), 0.0)
            if hit > share * (b - a):
                return False
            kept.append((a, b))
            return True

        return fine

    return scan_groups(df, key, ["start", "end", *ties], ["start", "end"], judge)


def capped_groups(df: DataFrame, key: str, start: str, end: str, gap: float, most: float, out: str = "grp") -> DataFrame:
    """Adds out: 1, 2, ... within each key; a new group where the gap to the end before is at least gap or the group would last over most."""

    def judge():
        state: list[float] = []

        def number(a: float, b: float) -> int:
            if not state:
                state[:] = [1, a, b]
            elif a - state[2] >= gap or b - state[1] > most:
                state[:] = [state[0] + 1, a, b]
            else:
                state[2] = b
            return int(state[0])

        return number

    return scan_groups(df, key, [start, end], [start, end], judge, out)


def best_in_windows(df: DataFrame, key: str, at: str, score: str, width: float = 0.5, ties: Sequence[str] = ()) -> DataFrame:
    """The best row of each window (of equal ones the first by at, then by ties); a window starts at the first row after the one before ended."""

    def starts():
        state: list[float] = []

        def first(t: float) -> bool:
            if state and t < state[0] + width:
                return False
            state[:] = [t]
            return True

        return first

    opening = scan_groups(df.select(key, at).distinct(), key, [at], [at], starts).withColumn("__open", F.col(at))
    marked = df.join(opening, [key, at], "left")
    window = F.last("__open", True).over(Window.partitionBy(key).orderBy(at).rangeBetween(Window.unboundedPreceding, 0))
    return top_per_group(marked.withColumn("__window", window), [key, "__window"], [F.col(score).desc(), F.col(at), *[F.col(c) for c in ties]]).drop("__open", "__window").select(df.columns)
