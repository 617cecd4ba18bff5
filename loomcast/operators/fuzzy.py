"""Titles that match by the ratio of their matching blocks, compared in tiles.

The ratio is 2 M / S for M characters in matching blocks of two titles of S characters
together. The blocks are a common subsequence, and a common bag of characters, so a longest
common subsequence (bit-parallel, for all pairs of a tile at once) and before it the counts
of the characters bound M from above; only what they leave is compared block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.functions.text_udfs import title_ratios
from loomcast.operators.reliable import cut
from loomcast.operators.windows import top_per_group

#: Titles of a side of a tile at most; fewer where a key has fewer, so that there are tasks for all cores.
TILE_TITLES, SMALL_TILE = 1024, 128
#: Characters are told apart in so many classes; longer titles than so many words of 64 characters are bounded by their characters alone.
CLASSES, WORDS = 64, 4
#: Titles of more classes of size than so many are looked up by ranges of sizes.
MANY = 32
#: Cells of a matrix, and pairs, that are worked out at once.
CELLS, PAIRS = 1 << 18, 1 << 14


def plain_title(title: Column) -> Column:
    """Lower case, trimmed, only words and white space."""
    return F.regexp_replace(F.lower(F.trim(title)), r"(?U)[^\w\s]", "")


class _Titles:
    """Titles in the order of their lengths: counts of their characters' classes, the classes by place, and a bit mask of places for each class."""

    def __init__(self, points: list[np.ndarray], known: np.ndarray, of: np.ndarray) -> None:
        lengths = np.array([len(p) for p in points])
        self.order = np.argsort(lengths, kind="stable")
        self.n = lengths[self.order]
        held = int(np.searchsorted(self.n, 64 * WORDS, side="right"))  # those whose places are kept
        width = int(self.n[held - 1]) if held else 0
        self.counts = np.zeros((CLASSES, len(points)), np.min_scalar_type(int(self.n.max())))
        self.places = np.full((width, held), CLASSES, np.uint8)
        for k, at in enumerate(self.order):
            classes = of[np.searchsorted(known, points[at])]
            self.counts[:, k] = np.bincount(classes, minlength=CLASSES)
            if k < held:
                self.places[: len(classes), k] = classes
        self.masks = np.zeros((-(-width // 64), held * (CLASSES + 1)), np.uint64)
        for p, classes in enumerate(self.places):
            some = np.flatnonzero(classes < CLASSES)
            self.masks[p // 64, some * (CLASSES + 1) + classes[some]] |= np.uint64(1 << p % 64)


def _common(a: _Titles, b: _Titles, i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Lengths of the longest common subsequences of pairs whose first titles all have n characters."""
    left = [np.full(len(i), ~np.uint64(0)) for _ in range(-(-n // 64))]  # a zero bit: one more character in common
    line = i * (CLASSES + 1)
    if len(left) == 1:
        v, one, u = left[0], a.masks[0], np.empty_like(left[0])
        for classes in b.places[: int(b.n[j].max())]:
            np.bitwise_and(v, one[line + classes[j]], out=u)
            s = v + u
            v -= u
            v |= s
        return np.bitwise_count(~v & np.uint64((1 << n) - 1)).astype(int)
    for classes in b.places[: int(b.n[j].max())]:
        cell, carry = line + classes[j], np.uint64(0)
        for w, v in enumerate(left):
            u = v & a.masks[w][cell]
            s = v + u
            over = s < u
            if w:
                s += carry
                over |= s < carry
            carry = over.astype(np.uint64)
            left[w] = s | (v - u)
    return sum(np.bitwise_count(~v & np.uint64((1 << min(64, n - 64 * w)) - 1)).astype(int) for w, v in enumerate(left))


def possible_pairs(a: list[str], b: list[str] | None, ratio: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The places of pairs of titles, none empty, that may match by `ratio` or more: all that do are among them.

    Without b each pair of two different places of a comes once, in either order.
    """
    same = b is None
    points = [[np.frombuffer(t.lower().encode("utf-32-le"), np.uint32) for t in x] for x in ((a,) if same else (a, b))]
    known, seen = np.unique(np.concatenate([p for x in points for p in x]), return_counts=True)
    rank = np.empty(len(known), int)
    rank[np.argsort(-seen, kind="stable")] = np.arange(len(known))
    own = CLASSES * 3 // 4  # frequent characters are classes of their own
    of = np.where(rank < own, rank, own + rank % (CLASSES - own)).astype(np.uint8)
    x = _Titles(points[0], known, of)
    y = x if same else _Titles(points[1], known, of)
    for n in np.unique(x.n):
        rows = np.arange(np.searchsorted(x.n, n), np.searchsorted(x.n, n, side="right"))
        need = np.ceil(ratio * (n + y.n) / 2 - 1e-9).astype(int)
        fits = np.flatnonzero(need <= np.minimum(n, y.n))
        if not len(fits):
            continue
        low, high = fits[0], fits[-1] + 1  # lengths that fit lie together
        if same:
            low = max(low, rows[0])
        if low >= high:
            continue
        least = np.minimum(need, np.iinfo(x.counts.dtype).max).astype(np.result_type(x.counts, y.counts))
        step = max(1, CELLS // (high - low))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            common = np.zeros((len(some), high - low), least.dtype)
            one = np.empty_like(common)
            for c in np.flatnonzero(x.counts[:, some].any(axis=1)):
                common += np.minimum(x.counts[c, some][:, None], y.counts[c, low:high], out=one, dtype=least.dtype)
            i, j = np.divmod(np.flatnonzero(common >= least[low:high]), high - low)
            i, j = some[i], low + j
            if same:
                i, j = i[i < j], j[i < j]
            for k in range(0, len(i), PAIRS):
                p, q = i[k : k + PAIRS], j[k : k + PAIRS]
                short = (y.n[q] <= 64 * WORDS) & (n <= 64 * WORDS)
                keep = ~short
                if short.any():
                    keep[short] = _common(x, y, p[short], q[short], int(n)) >= need[q[short]]
                yield x.order[p[keep]], y.order[q[keep]]


def _matches(a: list[str], b: list[str] | None, ratio: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and ratios of the pairs of titles that match; without b those of all ordered pairs of a."""
    found = [(np.zeros(0, int), np.zeros(0, int), np.zeros(0))]
    other = a if b is None else b

    def take(i: np.ndarray, j: np.ndarray) -> None:
        value = np.array(title_ratios([a[k] for k in i], [other[k] for k in j], ratio), float)
        keep = value >= ratio
        found.append((i[keep], j[keep], value[keep]))

    for i, j in possible_pairs(a, b, ratio):
        take(i, j)
        if b is None:
            take(j, i)  # matching blocks depend on the order
    if b is None:
        take(np.arange(len(a)), np.arange(len(a)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _by_key(table: pa.Table) -> dict:
    """The places of each key's rows."""
    keys = table.column("key").to_pandas()
    return keys.groupby(keys).indices


def title_pairs(left: DataFrame, right: DataFrame | None = None, ratio: float = 0.75) -> DataFrame:
    """(key, a, b, ratio) of the distinct titles of left and right (key, title) of one key that match by `ratio` or more.

    A key's titles are dealt into parts by hash, and each part of one side meets each of the
    other in a task; keys of few titles share tasks. No match is left out. Without right the
    titles of left meet each other, each two parts once.
    """
    same = right is None
    sides = [x.where("key is not null and title is not null and title <> ''").select("key", "title").distinct() for x in ((left,) if same else (left, right))]
    n = F.count(F.lit(1))
    parts = F.greatest(F.lit(1), F.ceil(n / TILE_TITLES), F.least(F.lit(8), F.ceil(n / SMALL_TILE))).cast("int")
    sizes = [x.groupBy("key").agg(parts.alias(p)) for x, p in zip(sides, ("p", "q"), strict=False)]
    sizes = sizes[0].withColumn("q", F.col("p")) if same else sizes[0].join(sizes[1], "key")
    shared = sides[0].agg(F.greatest(F.lit(1), F.ceil(n / TILE_TITLES)).alias("shared"))  # tasks of the small keys
    group = F.when((F.col("p") == 1) & (F.col("q") == 1), F.pmod(F.xxhash64("key"), F.col("shared"))).otherwise(F.xxhash64("key"))
    sizes = sizes.crossJoin(F.broadcast(shared)).select("key", "p", "q", group.alias("g"))
    first, second = sides[0].join(sizes, "key"), sides[-1].join(sizes, "key")
    own = lambda count: F.pmod(F.xxhash64("title"), F.col(count)).cast("int")
    first, second = first.withColumn("i", own("p")), second.withColumn("j", own("q"))
    first = first.select("key", "title", "g", "i", F.explode(F.sequence(F.col("i") if same else F.lit(0), F.col("q") - 1)).alias("j"))
    second = second.select("key", "title", "g", F.explode(F.sequence(F.lit(0), F.col("j") if same else F.col("p") - 1)).alias("i"), "j").toDF("key", "title", "g", "i", "j")  # names of its own
    # Few bytes, but much work each: dealt to all tasks.
    tasks = 4 * left.sparkSession.sparkContext.defaultParallelism
    first, second = (x.repartition(tasks, "g", "i", "j") for x in (first, second))
    names = ["key", "a", "b", "ratio"]

    def run(tile: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
        whole = same and tile[1].as_py() == tile[2].as_py()
        rows, others = _by_key(a), _by_key(b)
        found = [pa.table([*a.select(["key", "title", "title"]).slice(0, 0).columns, pa.array([], pa.float64())], names=names)]
        for key, at in rows.items():
            if key not in others:
                continue
            mine, met = a.take(pa.array(at)), b.take(pa.array(others[key]))
            titles = [x.column("title").to_pylist() for x in (mine, met)]
            i, j, value = _matches(titles[0], None if whole else titles[1], ratio)
            met = mine if whole else met
            found.append(pa.table([*mine.select(["key", "title"]).take(pa.array(i)).columns, met.column("title").take(pa.array(j)), pa.array(value)], names=names))
            if same and not whole:  # the other order
                i, j, value = _matches(titles[1], titles[0], ratio)
                found.append(pa.table([*met.select(["key", "title"]).take(pa.array(i)).columns, mine.column("title").take(pa.array(j)), pa.array(value)], names=names))
        return pa.concat_tables(found)

    schema = f"key {sides[0].schema['key'].dataType.simpleString()}, a string, b string, ratio double"
    return first.groupBy("g", "i", "j").cogroup(second.groupBy("g", "i", "j")).applyInArrow(run, schema)


def _alike(size: Column) -> Column:
    """(level, node) of the ranges of sizes, each of 2 ** level whole numbers, that together are those within a tenth of size."""
    width = F.floor(0.1 * size)
    low, high = size - width, size + width + 1

    def at(level: Column) -> Column:
        length = F.pow(F.lit(2.0), level)
        first, end = F.ceil(low / length), F.floor(high / length)
        odd = lambda x: (first < end) & (F.pmod(x, F.lit(2)) == 1)
        node = lambda x: F.struct(level.alias("level"), x.cast("long").alias("node"))
        return F.array(F.when(odd(first), node(first)), F.when(odd(end), node(end - 1)))

    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(31)), at)))


def _ranges(size: Column) -> Column:
    """(level, node) of the ranges that a size lies in, of the levels that _alike may ask for."""
    most = F.floor(F.log2(0.23 * F.greatest(size, F.lit(0)) + 2)).cast("int")
    node = lambda level: F.floor(size / F.pow(F.lit(2.0), level)).cast("long")
    return F.transform(F.sequence(F.lit(0), most), lambda level: F.struct(level.alias("level"), node(level).alias("node")))


def best_matches(rows: DataFrame, row_id: str, size: str, ratio: float = 0.75) -> DataFrame:
    """(row_id, other_id, score): of each row of (key, title, row_id, size) the best other row whose title matches.

    The score is the ratio, 0.15, 0.10 or 0.05 more for ids up to 7, 14 or 30 apart, and 0.1
    more for a size within a tenth of the row's; of equal ones the least id counts. Rows of one
    title and size are one class with its two least ids, and titles of many classes have the two
    least ids of ranges of sizes, so copies don't meet each other one by one; rows of near ids
    meet in blocks of ids.
    """
    rows = cut(rows.where(F.col("key").isNotNull() & F.col("title").isNotNull() & F.col(row_id).isNotNull()).select("key", "title", F.col(row_id).alias("id"), F.col(size).cast("long").alias("n")))
    found = cut(title_pairs(rows, ratio=ratio)).toDF("key", "title", "other_title", "ratio")
    others = rows.toDF("key", "other_title", "other_id", "other_n")
    alike = F.when(F.abs(F.col("n") - F.col("other_n")) <= 0.1 * F.col("n"), 0.1).otherwise(0.0)
    # Without the bonus of near ids, which can only add: a row's best two, as one may be the row itself.
    held = top_per_group(others.distinct(), ["key", "other_title", "other_n"], [F.col("other_id")], 2)
    held = cut(held.join(held.groupBy("key", "other_title").agg((F.count(F.lit(1)) > MANY).alias("many")), ["key", "other_title"]))
    asked = rows.select("key", "title", "n").distinct().join(found, ["key", "title"])
    few = asked.join(held.where("not many"), ["key", "other_title"]).withColumn("score", F.round(F.col("ratio") + alike, 6))
    whole = F.array(F.struct(F.lit(-1).alias("level"), F.lit(0).cast("long").alias("node")))  # all sizes
    of = lambda ranges: F.explode(F.concat(whole, F.coalesce(ranges, F.slice(whole, 1, 0)))).alias("r")
    many = held.where("many").select("key", "other_title", "other_id", of(_ranges(F.col("other_n")))).distinct()
    many = top_per_group(many, ["key", "other_title", "r"], [F.col("other_id")], 2)
    some = asked.join(held.where("many").select("key", "other_title").distinct(), ["key", "other_title"]).select("*", of(_alike(F.col("n"))))
    some = some.join(many, ["key", "other_title", "r"]).withColumn("score", F.round(F.col("ratio") + F.when(F.col("r.level") >= 0, 0.1).otherwise(0.0), 6))
    met = few.select("key", "title", "n", "other_id", "score").unionByName(some.select("key", "title", "n", "other_id", "score"))
    met = met.groupBy("key", "title", "n", "other_id").agg(F.max("score").alias("score"))
    two = top_per_group(met, ["key", "title", "n"], [F.col("score").desc(), F.col("other_id")], 2)
    far = rows.join(two.withColumnRenamed("n", "m"), ["key", "title"]).where(F.col("n").eqNullSafe(F.col("m")))
    apart = F.abs(F.col("id") - F.col("other_id"))
    near = F.when(apart <= 7, 0.15).when(apart <= 14, 0.10).otherwise(0.05)
    block = F.floor(F.col("id") / 30)
    beside = rows.withColumn("block", F.explode(F.array(block - 1, block, block + 1)))
    close = beside.join(others.withColumn("block", F.floor(F.col("other_id") / 30)), ["key", "block"]).where(apart <= 30)
    close = close.join(found, ["key", "title", "other_title"]).withColumn("score", F.round(F.col("ratio") + (near + alike), 6))
    both = far.select("id", "other_id", "score").unionByName(close.select("id", "other_id", "score")).where("id <> other_id")
    return top_per_group(both, ["id"], [F.col("score").desc(), F.col("other_id")]).select(F.col("id").alias(row_id), "other_id", "score")


def fuzzy_matches(left: DataFrame, right: DataFrame, ratio: float = 0.75) -> DataFrame:
    """Rows of left (key, title, ...) with those of right (key, other_title, ...) that match, and the ratio; other names must differ."""
    found = title_pairs(left, right.withColumnRenamed("other_title", "title"), ratio).toDF("key", "title", "other_title", "ratio")
    return left.join(found, ["key", "title"]).join(right, ["key", "other_title"])
