"""Near-duplicates by true similarity of word shingles, five words wide.

A text is the set of its shingles. Two sorts of keys propose pairs: the Golay keys of the
sets' SimHash fingerprints (module simhash), which miss no pair within three bits, and
MinHash bands for the pairs beyond. A pair is linked only if the Jaccard similarity of the
two whole sets, counted exactly, reaches the limit. A pair at similarity s shares a band
with probability 1 - (1 - s^ROWS)^BANDS: 0.9999 at 0.8, more above. Fingerprints alone
can't propose them all: at 0.8 two of 64 bits differ in 10 on average, beyond what
selective keys reach.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomcast.llm import simhash
from loomcast.llm.common import components, cut, let_go, spread_join, stay, worker_keeps
from loomcast.operators.reliable import row_numbers

BANDS, ROWS = 24, 5
SHINGLES_AT_ONCE = 1 << 12
#: Components of up to so many classes are compared class by class at once.
FEW = 3
#: Shingles of the classes of a side of a task that holds classes against a component.
SHINGLES_A_PART = 1 << 19
#: A set's sketch counts its shingles by their first byte; larger counts than a byte holds have no sketch.
BINS = 256
_RNG = np.random.default_rng(42)
_FIRST, _SECOND = (_RNG.integers(0, 1 << 64, size=(BANDS * ROWS, 1), dtype=np.uint64) | np.uint64(1) for _ in range(2))


def shingles(text: bytes, width: int = 5, seed: int = 42) -> np.ndarray:
    """Sorted distinct XXH64 of the text's shingles; a shorter text is one shingle, one without words has none."""
    import xxhash

    words = text.lower().split()  # bytes: only A-Z are lowered, only ASCII white space splits
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(joined, seed)], dtype=np.uint64)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    spans = zip((ends - lengths).tolist(), ends[width - 1 :].tolist(), strict=False)
    return np.unique(np.fromiter((digest(joined[a:b], seed) for a, b in spans), dtype=np.uint64, count=len(words) - width + 1))


def fingerprint(hashes: np.ndarray) -> int:
    """SimHash of a set: a bit is set if it is set in over half the hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), SHINGLES_AT_ONCE):
        part = hashes[at : at + SHINGLES_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > len(hashes)).tolist())


def bands(hashes: np.ndarray) -> np.ndarray:
    """A key for each band of a set's MinHash values; none for the empty set."""
    import xxhash

    if not len(hashes):
        return np.zeros(0, dtype=np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), SHINGLES_AT_ONCE):
        mixed = hashes[None, at : at + SHINGLES_AT_ONCE] * _FIRST
        mixed ^= mixed >> np.uint64(32)
        mixed *= _SECOND
        least = np.minimum(least, mixed.min(axis=1))
    keys = [xxhash.xxh64_intdigest(values.tobytes(), band) for band, values in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(keys, dtype=np.uint64).view(np.int64)


def sketch(hashes: np.ndarray) -> bytes | None:
    """How many of a set's hashes begin with each byte; the sum of the smaller counts of two sets is at least what they share."""
    counts = np.bincount((hashes >> np.uint64(56)).astype(np.int64), minlength=BINS)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else None


def _texts(batches: Iterator[pa.RecordBatch], column: int, width: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], list[str]]]:
    """(batch, sets, 128-bit digests of the sets) of at most 1,000 rows at once."""
    import xxhash

    worker_keeps()
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            sets = [shingles(t.as_buffer().to_pybytes() if t.is_valid else b"", width) for t in part.column(column)]
            yield part, sets, [xxhash.xxh3_128_hexdigest(s.tobytes()) for s in sets]


def _classes_of(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, dig, fp, bands) of each row; rows of equal shingle sets share dig."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets, digests in _texts(batches, 1, width):
            keys = pa.array([bands(s) for s in sets], pa.list_(pa.int64()))
            prints = np.array([fingerprint(s) for s in sets], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(digests), pa.array(prints), keys], names=["id", "dig", "fp", "bands"])

    return docs.select(id_col, F.col(text_col).cast("binary").alias("__text")).mapInArrow(run, f"id {kind}, dig string, fp long, bands array<long>")


def _sets_of(docs: DataFrame, text_col: str, width: int) -> DataFrame:
    """(dig, s, n, sketch): each distinct shingle set of docs, its size and sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets, digests in _texts(batches, 0, width):
            values = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.string()), values, pa.array(map(len, sets), pa.int32()), pa.array(map(sketch, sets), pa.binary())], names=["dig", "s", "n", "sketch"])

    return docs.select(F.col(text_col).cast("binary").alias("__text")).mapInArrow(run, "dig string, s array<long>, n int, sketch binary").dropDuplicates(["dig"])


@F.pandas_udf(T.IntegerType())
def _at_most(x: pd.Series, y: pd.Series) -> pd.Series:
    """The most shingles that two sets of these sketches share; null if either has none."""
    able = x.notna() & y.notna()
    out = pd.Series(np.nan, index=x.index, dtype="Float64")
    if able.any():
        a, b = (np.frombuffer(b"".join(z[able]), np.uint8).reshape(-1, BINS) for z in (x, y))
        out[able] = np.minimum(a, b).sum(axis=1, dtype=np.int64)
    return out.astype("Int32")


def _prefixes(sets: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(key, n, cls) to index and to probe with: two similar sets share a key if the smaller (by n, cls) is taken from the first.

    Keys are the first shingles of a set, the rarest first. Sets of sizes m <= n at
    Jaccard t share at least t n and 2 t m / (1 + t) shingles, so that n - ceil(t n) + 1
    and m - ceil(2 t m / (1 + t)) + 1 of them in one order must meet.
    """
    each = sets.select("cls", F.size("s").alias("n"), F.explode("s").alias("key"))
    counted = each.join(each.groupBy("key").agg(F.count(F.lit(1)).alias("df")), "key")
    order = cut(counted.groupBy("cls", "n").agg(F.sort_array(F.collect_list(F.struct("df", "key"))).alias("o")))

    def first(share: float) -> DataFrame:
        size = (F.col("n") - F.ceil(F.col("n") * share - 1e-9) + 1).cast("int")
        return order.select("n", "cls", F.explode(F.slice("o", F.lit(1), size)).alias("k")).where("k.df > 1").select("k.key", "n", "cls")

    return first(2 * similarity / (1 + similarity)), first(similarity)


def _one_of(asked: DataFrame, members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b): for each asked (q, big) one class of members (cls, big) that is similar to class q, if there is one.

    Classes and members are dealt into parts of about SHINGLES_A_PART shingles by hash; two
    parts meet in a task, which counts what each class shares with all members at once and
    yields one of the similar ones, so that pairs are no rows. All members of a big one are
    linked to each other already.
    """
    parts = F.greatest(F.lit(1), F.ceil(F.sum("n") / SHINGLES_A_PART)).cast("int")
    left = asked.join(sets.select(F.col("cls").alias("q"), "n", "s"), "q")
    right = members.join(asked.select("big").distinct(), "big", "left_semi").join(sets.select("cls", "n", "s"), "cls")
    sizes = cut(asked.join(sets.select(F.col("cls").alias("q"), "n"), "q").groupBy("big").agg(parts.alias("asked_parts")).join(members.join(sets.select("cls", "n"), "cls").groupBy("big").agg(parts.alias("parts")), "big"))
    own = lambda name, count: F.pmod(F.xxhash64(name), F.col(count)).cast("int")
    all_of = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    left = left.join(sizes, "big").select("big", F.col("q").alias("cls"), "s", own("q", "asked_parts").alias("i"), all_of("parts").alias("j"))
    right = right.join(sizes, "big").select("big", "cls", "s", all_of("asked_parts").alias("i"), own("cls", "parts").alias("j")).toDF("big", "cls", "s", "i", "j")  # names of its own

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        found = []
        if len(a) and len(b):
            held = b.column("s").combine_chunks()
            lengths = held.value_lengths().to_numpy(zero_copy_only=False)
            values = held.flatten().to_numpy(zero_copy_only=False)
            order = np.argsort(values, kind="stable")
            values, owner = values[order], np.repeat(np.arange(len(lengths)), lengths)[order]
            ids = b.column("cls").to_numpy()
            for q, s in zip(a.column("cls").to_pylist(), a.column("s"), strict=True):
                own = s.values.to_numpy(zero_copy_only=False)
                low = np.searchsorted(values, own)
                many = np.searchsorted(values, own, side="right") - low
                at = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())  # the places of what they share
                shared = np.bincount(owner[at], minlength=len(lengths))
                hit = np.flatnonzero(shared / (len(own) + lengths - shared) >= similarity)
                if len(hit):
                    found.append(sorted((q, int(ids[hit[0]]))))
        return pa.table([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return left.groupBy("big", "i", "j").cogroup(right.groupBy("big", "i", "j")).applyInArrow(run, "a long, b long")


def _between(sets: DataFrame, index: DataFrame, probe: DataFrame, found: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of classes of different components that may be similar, and pairs that are; with these all such components meet that have a similar pair.

    Components that share a key of _prefixes meet once. Each class of the one with fewer
    classes is then held against all shingles of the other together: a class of m shingles
    has at least t / (1 + t) (n + m) in common with a similar one of n, so a class that
    shares fewer with the whole component is similar to none of it, and a large component
    isn't compared class by class with what lies just outside it. What isn't ruled out by
    that meets the component's classes in tasks (_one_of); with components of at most FEW
    classes it is paired.
    """
    t = similarity
    where = sets.select("cls", F.size("s").alias("n")).join(found, "cls", "left").select("cls", "n", F.coalesce("component", "cls").alias("of"))
    where = cut(where)
    left, right = (x.select("key", "cls").join(where.select("cls", F.col("of").alias(name)), "cls").select("key", name).distinct() for x, name in ((index, "x"), (probe, "y")))
    met = left.join(right, "key").where("x <> y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    sizes = where.groupBy("of").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("lo"), F.max("n").alias("hi"))
    both = met.join(sizes.toDF("x", "kx", "lx", "hx"), "x").join(sizes.toDF("y", "ky", "ly", "hy"), "y")
    fewer = F.col("kx") <= F.col("ky")
    pick = lambda a, b: F.when(fewer, F.col(a)).otherwise(F.col(b))
    sides = both.select(pick("x", "y").alias("of"), pick("y", "x").alias("big"), pick("ky", "kx").alias("k"), pick("ly", "lx").alias("lo"), pick("hy", "hx").alias("hi"))
    asked = sides.join(where.withColumnRenamed("cls", "q"), "of").where((F.col("hi") >= t * F.col("n")) & (t * F.col("lo") <= F.col("n"))).select("q", "n", "big", "k", "lo")
    asked = cut(asked)
    let_go(sets.sparkSession)
    large = asked.where(F.col("k") > FEW)
    whole = where.join(large.select(F.col("big").alias("of")).distinct(), "of", "left_semi").join(sets, "cls").select(F.col("of").alias("big"), F.explode("s").alias("key")).distinct()
    own = large.join(sets.select(F.col("cls").alias("q"), "s"), "q").select("q", "n", "big", "lo", F.explode("s").alias("key"))
    shared = own.join(whole, ["big", "key"]).groupBy("q", "n", "big", "lo").agg(F.count(F.lit(1)).alias("c"))
    able = shared.where(F.col("c") >= t / (1 + t) * (F.col("n") + F.greatest(t * F.col("n"), "lo")) - 1e-9).select("q", "big")
    links = cut(_one_of(cut(able), where.select("cls", F.col("of").alias("big")), sets, t).distinct())
    few = asked.where(F.col("k") <= FEW).select("q", "n", "big")
    pairs = few.join(where.toDF("m", "nm", "big"), "big").where((F.col("nm") >= t * F.col("n")) & (t * F.col("nm") <= F.col("n")))
    return pairs.select(F.least("q", "m").alias("a"), F.greatest("q", "m").alias("b")).distinct(), links


def _groups(docs: DataFrame, id_col: str, text_col: str, width: int, similarity: float) -> DataFrame:
    """(id, cls, grp, least), one row per row of docs: its class, its group's least class and its group's smallest id."""
    rows = cut(_classes_of(docs, id_col, text_col, width))
    classes = cut(rows.groupBy("dig").agg(F.min("id").alias("least_id"), F.first("fp").alias("fp"), F.first("bands").alias("bands")))
    classes = cut(row_numbers(classes, "cls")[0])
    keys = classes.select("cls", F.explode("bands").alias("key"))
    heads = keys.groupBy("key").agg(F.min("cls").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    keys = cut(keys.join(heads, "key"))
    prints = cut(classes.where(F.size("bands") > 0).groupBy("fp").agg(F.min("cls").alias("head")))
    near = simhash.links(prints).join(prints.toDF("a", "x"), "a").join(prints.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    alike = classes.join(prints, "fp").where("cls <> head").select(F.col("head").alias("a"), F.col("cls").alias("b"))
    proposed = keys.where("cls <> head").select(F.col("head").alias("a"), F.col("cls").alias("b")).unionByName(near).unionByName(alike)
    proposed = cut(proposed.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    met = proposed.select(F.col("a").alias("cls")).unionByName(proposed.select(F.col("b").alias("cls"))).distinct()
    # One row of each class that was met brings its text: by id where it has one.
    ids = classes.join(met, "cls", "left_semi").select(F.col("least_id").alias(id_col))
    asked = docs.select(id_col, text_col)
    some = asked.join(ids.where(F.col(id_col).isNotNull()).select(id_col).distinct(), id_col, "left_semi").unionByName(asked.where(F.col(id_col).isNull()))
    sets = cut(_sets_of(some, text_col, width).join(classes.select("dig", "cls"), "dig").drop("dig"))

    def similar(pairs: DataFrame) -> DataFrame:
        """The pairs at the limit; sizes rule out first, then sketches, and only what is left meets as sets."""
        t, share = similarity, similarity / (1 + similarity)
        for c in "ab":
            pairs = pairs.join(sets.select(F.col("cls").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"k{c}")), c)
        pairs = pairs.where((F.col("na") >= t * F.col("nb") - 1e-9) & (F.col("nb") >= t * F.col("na") - 1e-9))
        pairs = pairs.select("a", "b", "na", "nb", _at_most("ka", "kb").alias("most"))
        pairs = cut(pairs.where(F.col("most").isNull() | (F.col("most") >= share * (F.col("na") + F.col("nb")) - 1e-9)).select("a", "b"))
        both = pairs.join(sets.select(F.col("cls").alias("a"), F.col("s").alias("x")), "a").join(sets.select(F.col("cls").alias("b"), F.col("s").alias("y")), "b")
        shared = F.size(F.array_intersect("x", "y"))
        found = cut(both.where(shared / (F.size("x") + F.size("y") - shared) >= similarity).select("a", "b"))
        let_go(docs.sparkSession)
        return found

    let_go(docs.sparkSession)
    first = similar(proposed)
    # Buckets with a row that isn't linked to their head itself.
    loose = keys.where("cls <> head").select("key", F.least("head", "cls").alias("a"), F.greatest("head", "cls").alias("b")).join(first, ["a", "b"], "left_anti")
    some = keys.join(loose.select("key").distinct(), "key", "left_semi").select("cls").distinct()
    index, probe = _prefixes(sets.join(some, "cls", "left_semi"), similarity)
    heads = index.groupBy("key").agg(F.min(F.struct("n", "cls")).alias("h"))
    second = similar(probe.join(heads, "key").where(F.struct("n", "cls") > F.col("h")).select(F.col("h.cls").alias("a"), F.col("cls").alias("b")).distinct())
    found = cut(components(first.unionByName(second)).withColumnRenamed("node", "cls"))
    let_go(docs.sparkSession)
    rest, links = _between(sets.join(some, "cls", "left_semi"), index, probe, found, similarity)
    linked = components(first.unionByName(second).unionByName(similar(rest)).unionByName(links)).withColumnRenamed("node", "cls")
    let_go(docs.sparkSession)
    of = classes.join(linked, "cls", "left").select("cls", "least_id", F.coalesce("component", "cls").alias("grp"))
    least = of.groupBy("grp").agg(F.min("least_id").alias("least"))
    of = of.join(classes.select("cls", "dig"), "cls").join(least, "grp").select("dig", "grp", "least")
    return spread_join(rows.select("id", "dig"), of, ["dig"]).select("id", F.col("dig").alias("cls"), "grp", "least")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8) -> DataFrame:
    """(id, component_id): one row per row of docs; component_id is the smallest id reachable over linked pairs.

    Each bucket's rows are first compared with its least one. Rows of buckets in which that
    doesn't link all are compared once more, by keys that miss no pair (_prefixes): first
    with a head for each key, then between components only, as other pairs can't change
    the result. So a large group of near copies isn't compared pair
    by pair, whether its members are similar enough or not.

    A null text is empty; texts without words are alike and similar to no other; a text of
    fewer words than width is one shingle. A row with a null id gets its group's component,
    null if no row of the group has an id. Repeated rows and ids stay separate rows. Very
    long texts count whole. An empty table gives an empty result; other columns are
    ignored, whatever their names.
    """
    found = _groups(docs, id_col, text_col, width, similarity)
    return found.select(F.col("id").alias(id_col), F.col("least").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row of docs for each near-duplicate group, with all its columns: a row of the group's smallest id.

    Of a group's rows that share that id one stays, of a group without any id one too.
    """
    def class_of(rows: DataFrame, name: str) -> DataFrame:
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        at = rows.columns.index(text_col)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, _, digests in _texts(batches, at, width):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(digests, pa.string())], names=[*part.schema.names, name])

        return rows.mapInArrow(run, f"{kinds}, `{name}` string")

    return stay(docs, id_col, _groups(docs, id_col, text_col, width, similarity), class_of)
