"""Exact vector search, reranking and diverse selection."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcast.functions import scores as S
from loomcast.functions.vectors import dot, normalised
from loomcast.operators.reliable import cut as reliable
from loomcast.operators.windows import top, top_per_group

#: Queries scored against all rows in one pass; more are taken in blocks of about this many.
QUERY_BLOCK = 1000
#: Queries, and rows, of a tile at most, and the similarities that are worked out at once.
TILE_QUERIES, TILE_ROWS, TILE_STEP = 32768, 65536, 1 << 22
#: Pairs whose similarity is worked out exactly at once; of a step's pairs, one in so many at most is taken out before all are worked out exactly.
PAIRS_AT_ONCE, FEW = 1 << 16, 16
#: Pairs of keys that some_pair looks up before a step.
KEYS_AT_ONCE = 1 << 16
#: Rows of a group that diverse chooses from in one task.
GROUP_AT_ONCE = 1 << 14


class Tile:
    """Some queries and some rows: their columns, unit vectors, and the same in single precision.

    A quick similarity (single precision) is less than `off` away from the exact one,
    which is in double precision and rounded; so quick ones tell which few pairs matter,
    and those are worked out exactly.
    """

    def __init__(self, queries: pa.Table, rows: pa.Table, x: np.ndarray, y: np.ndarray, digits: int) -> None:
        self.queries, self.rows, self.x, self.y, self.digits = queries, rows, x, y, digits
        self.quick_x, self.quick_y = x.astype(np.float32), np.ascontiguousarray(y.T, dtype=np.float32)
        self.off = np.float32((x.shape[1] + 4) * 2.0**-23 + 10.0**-digits)

    def steps(self, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The queries i in turns, each with its quick similarities to the rows j."""
        y = self.quick_y if len(j) == len(self.y) else np.ascontiguousarray(self.quick_y[:, j])
        step = max(1, TILE_STEP // max(1, len(j)))
        for at in range(0, len(i) if len(j) else 0, step):
            some = i[at : at + step]
            yield some, self.quick_x[some] @ y

    def exact(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Similarities of pairs."""
        out = np.empty(len(i))
        for at in range(0, len(i), PAIRS_AT_ONCE):
            s = slice(at, at + PAIRS_AT_ONCE)
            out[s] = np.einsum("ij,ij->i", self.x[i[s]], self.y[j[s]])
        return np.round(out, self.digits) + 0.0

    def all_exact(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return np.round(self.x[i] @ self.y[j].T, self.digits) + 0.0


#: Of one tile: the places of queries and of rows that it yields, and a value for each.
Chooser = Callable[[Tile], tuple[np.ndarray, np.ndarray, np.ndarray]]


def _groups(table: pa.Table, keys: Sequence[str]) -> list[np.ndarray]:
    """The places of each key's rows, in order; nulls are a key."""
    if not keys:
        return [np.arange(len(table))]
    of = table.select(list(keys)).to_pandas().groupby(list(keys), dropna=False).ngroup().to_numpy()
    return [np.flatnonzero(of == g) for g in np.unique(of)]


def _cells(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a matrix is true."""
    return np.divmod(np.flatnonzero(mask), mask.shape[1])


def _together(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not found:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _parts(count: Column, most: int, few: int = 8) -> Column:
    """Of so many rows: parts of about `most` rows, and up to `few` of fewer."""
    return F.greatest(F.lit(1), F.ceil(count / most), F.least(F.lit(few), F.ceil(count / 1024))).cast("int")


def tiled(rows: DataFrame, queries: DataFrame, choose: Chooser, row_id: str, vector: str, query_id: str, query_vector: str, value: str = "sim", block: str | None = None, part: Column | None = None, digits: int = 6, most: int | None = None, few: tuple[int, int] = (2, 16), once: bool = False) -> DataFrame:
    """Columns of queries and rows but for the vectors, and value, of what choose takes of each tile; cosine, rounded.

    Rows and queries are dealt into parts by hash (queries by `part` if given), and each part of
    one meets each of the other in a task, as matrices, some queries at once: the work is
    that of all pairs, what a task holds is bounded, and only what choose takes leaves it.
    block names a column of both; then only equal ones meet. Rows and queries without a
    vector are left out. A tile's rows lie in the order of their ids. few: up to so many
    parts of queries and of rows are made of what would fit one, for the sake of more tasks.
    once: queries and rows are the same rows, by id, and of two parts only one meets the
    other, so that each two rows meet in one order; needs most.
    """
    sides = []
    for df, name, vec, deal, usual, some in ((queries, query_id, query_vector, part, TILE_QUERIES, few[0]), (rows, row_id, vector, None, TILE_ROWS, few[1])):
        size, parts = (most, 8) if most else (usual, some)  # queries are few: their parts are what the rows are copied for
        held = df.where(F.col(vec).isNotNull()).withColumn("__x", normalised(F.col(vec))).drop(vec)
        hashed = F.xxhash64(name) if deal is None else F.xxhash64(deal)
        if block:
            held = held.where(F.col(block).isNotNull())
            held = held.join(held.groupBy(block).agg(_parts(F.count(F.lit(1)), size, parts).alias("__parts")), block)
        else:
            held = held.withColumn("__parts", _parts(F.lit(df.count()), size, parts))
        sides.append(held.withColumn("__own", F.pmod(hashed, F.col("__parts")).cast("int")))
    asked, met = sides
    keys = [block] if block else []
    if block:
        other = [s.select(block, F.col("__parts").alias("__others")).distinct() for s in (met, asked)]
        asked, met = asked.join(other[0], block), met.join(other[1], block)
    else:
        count = [s.agg(F.max("__parts").alias("__others")) for s in (met, asked)]
        asked, met = asked.crossJoin(F.broadcast(count[0])), met.crossJoin(F.broadcast(count[1]))
    each = F.explode(F.sequence(F.lit(0), F.col("__others") - 1))
    from_own, to_own = F.explode(F.sequence(F.col("__own"), F.col("__others") - 1)), F.explode(F.sequence(F.lit(0), F.col("__own")))
    plain = [[c for c in df.columns if c not in (vec, *hidden)] for df, vec, hidden in ((queries, query_vector, ()), (rows, vector, keys))]
    left = asked.select(*plain[0], "__x", F.col("__own").alias("__i"), (from_own if once else each).alias("__j"), *[F.col(c).alias("__b") for c in keys])
    right = met.select(*plain[1], "__x", (to_own if once else each).alias("__i"), F.col("__own").alias("__j"), *[F.col(c).alias("__b") for c in keys])
    fields = [queries.schema[c] for c in plain[0]] + [rows.schema[c] for c in plain[1]]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"`{value}` double"])
    out = [f.name for f in fields] + [value]

    def matrix(table: pa.Table) -> np.ndarray:
        return np.asarray(table.column("__x").combine_chunks().flatten().to_numpy(zero_copy_only=False), float).reshape(len(table), -1)

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        none = [*a.select(plain[0]).slice(0, 0).columns, *b.select(plain[1]).slice(0, 0).columns, pa.array([], pa.float64())]
        if not len(a) or not len(b):
            return pa.Table.from_arrays(none, names=out)
        sides = []
        for table in (a, b.take(pa.array(np.argsort(b.column(row_id).to_numpy(), kind="stable")))):
            x = matrix(table)
            whole = np.flatnonzero(np.isfinite(x).all(axis=1))
            sides.append((table.take(pa.array(whole)), x[whole]) if len(whole) < len(x) else (table, x))
        (a, x), (b, y) = sides
        a, b = a.select(plain[0]), b.select(plain[1])
        i, j, v = choose(Tile(a, b, x, y, digits))
        return pa.Table.from_arrays([*a.take(pa.array(i)).columns, *b.take(pa.array(j)).columns, pa.array(np.asarray(v, float))], names=out)

    return left.groupBy(*[f"__{c}" for c in ("b", "i", "j") if c != "b" or block]).cogroup(right.groupBy(*[f"__{c}" for c in ("b", "i", "j") if c != "b" or block])).applyInArrow(run, schema)


def _first_k(sims: np.ndarray, k: int) -> np.ndarray:
    """Which cells are among the k greatest of their line; of equal ones the first; never -inf."""
    if k < sims.shape[1]:
        kth = np.partition(sims, sims.shape[1] - k, axis=1)[:, sims.shape[1] - k]
        keep = sims >= kth[:, None]
        for line in np.flatnonzero(keep.sum(axis=1) > k):
            ties = np.flatnonzero(sims[line] == kth[line])
            keep[line, ties[k - int((sims[line] > kth[line]).sum()) :]] = False
    else:
        keep = np.ones(sims.shape, bool)
    return keep & (sims > -np.inf)


def _kth(sims: np.ndarray, k: int) -> np.ndarray:
    """Of each line a value that at least k cells reach, near the k-th greatest: the k-th of the maxima of disjoint sets of cells."""
    width = max(1, min(64, sims.shape[1] // (4 * k)))
    n = sims.shape[1] // width
    if n < k:
        return np.full(len(sims), -np.inf, np.float32)
    sets = np.lib.stride_tricks.as_strided(sims, (len(sims), width, n), (sims.strides[0], n * sims.strides[1], sims.strides[1]))
    return np.partition(sets.max(axis=1), n - k, axis=1)[:, n - k]


def best_rows(k: int, keys: Sequence[str] = (), least: float | Callable[[pa.Table], np.ndarray] | None = None, apart: tuple[str, str] | None = None) -> Chooser:
    """The k most similar rows of each query (and each of the row's keys), of those of at least `least`, which may differ by row.

    apart: columns of queries and rows; pairs of equal ones are left out.
    """

    def choose(t: Tile):
        low = np.full(len(t.rows), -np.inf) if least is None else np.broadcast_to(least(t.rows) if callable(least) else least, len(t.rows)).astype(float)
        own = [t.queries.column(apart[0]).to_numpy(), t.rows.column(apart[1]).to_numpy()] if apart else None
        found = []
        for rows in _groups(t.rows, keys):
            floor = low[rows].astype(np.float32)
            for queries, sims in t.steps(np.arange(len(t.queries)), rows):
                reached = _kth(sims, k + bool(apart))  # a query itself may be one of them
                if (reached < floor.max() + t.off).any():  # by rows that may not count
                    reached = _kth(np.where(sims >= floor + t.off, sims, np.float32(-np.inf)), k + bool(apart))
                near = sims >= np.maximum(reached, floor.min())[:, None] - 2 * t.off
                if np.count_nonzero(near) * FEW > near.size:  # many alike
                    whole = t.all_exact(queries, rows)
                    fits = whole >= low[rows]
                    if own:
                        fits &= own[0][queries][:, None] != own[1][rows]
                    i, j = _cells(_first_k(np.where(fits, whole, -np.inf), k))
                    found.append((queries[i], rows[j], whole[i, j]))
                    continue
                i, j = _cells(near)
                i, j = queries[i], rows[j]
                v = t.exact(i, j)
                fits = v >= low[j]
                if own:
                    fits &= own[0][i] != own[1][j]
                i, j, v = i[fits], j[fits], v[fits]
                order = np.lexsort((j, -v, i))
                i, j, v = i[order], j[order], v[order]
                keep = np.arange(len(i)) - np.searchsorted(i, i) < k
                found.append((i[keep], j[keep], v[keep]))
        return _together(found)

    return choose


def best_queries(least: float, key: str | None = None) -> Chooser:
    """Each row's most similar query (of each of the query's key) of at least `least`."""

    def choose(t: Tile):
        found = []
        for queries in _groups(t.queries, [key] if key else []):
            seen = np.full(len(t.rows), least, np.float32)  # the greatest quick similarity of each row so far
            best, whose = np.full(len(t.rows), -np.inf), np.zeros(len(t.rows), int)
            for some, sims in t.steps(queries, np.arange(len(t.rows))):
                np.maximum(seen, sims.max(axis=0), out=seen)
                near = sims >= seen - 2 * t.off
                if np.count_nonzero(near) * FEW > near.size:  # many alike
                    whole = t.all_exact(some, np.arange(len(t.rows)))
                    i, j = whole.argmax(axis=0), np.arange(len(t.rows))
                    i, v = some[i], whole[i, j]
                else:
                    i, j = _cells(near)
                    i = some[i]
                    v = t.exact(i, j)
                better = np.flatnonzero((v > best[j]) & (v >= least))
                i, j, v = i[better], j[better], v[better]
                order = np.lexsort((-i, v))  # the last one stays: the greatest, of equal ones the first query
                best[j[order]], whose[j[order]] = v[order], i[order]
            j = np.flatnonzero(best >= least)
            found.append((whose[j], j, best[j]))
        return _together(found)

    return choose


def count_rows(least: float) -> Chooser:
    """Each query with the number of rows of at least `least`, as the value; the row means nothing."""

    def choose(t: Tile):
        n = np.zeros(len(t.queries), int)
        for queries, sims in t.steps(np.arange(len(t.queries)), np.arange(len(t.rows))):
            near = sims >= np.float32(least) - 2 * t.off
            n[queries] = np.count_nonzero(near, axis=1)
            i, j = _cells(near & (sims < np.float32(least) + 2 * t.off))
            np.subtract.at(n, queries[i[t.exact(queries[i], j) < least]], 1)
        i = np.flatnonzero(n)
        return i, np.zeros(len(i), int), n[i]

    return choose


def some_pair(over: float, query_key: str, row_key: str, differ: bool = False) -> Chooser:
    """One pair over `over` of each two keys, of query and row, that have one; differ: of each two different keys, in either order.

    Queries come in the order of their keys, and rows whose keys have a pair with all keys
    of a step are left out of it.
    """

    def choose(t: Tile):
        both = [x.column(c).to_pandas() for x, c in ((t.queries, query_key), (t.rows, row_key))]
        if differ:
            keys = np.split(pd.factorize(pd.concat(both), use_na_sentinel=False)[0].astype(np.int64), [len(t.queries)])
        else:
            keys = [pd.factorize(x, use_na_sentinel=False)[0].astype(np.int64) for x in both]
        count = 1 + max(int(k.max(initial=-1)) for k in keys)
        found, known, order = [], np.zeros(0, np.int64), np.argsort(keys[0], kind="stable")

        def name(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return np.where(a == b, -1, np.minimum(a, b) * count + np.maximum(a, b)) if differ else a * count + b

        step = max(1, TILE_STEP // max(1, len(t.rows)))
        for at in range(0, len(order), step):
            asked, rows = order[at : at + step], np.arange(len(t.rows))
            own = np.unique(keys[0][asked])
            if len(own) * count <= KEYS_AT_ONCE:
                names = name(own[:, None], np.arange(count)[None])
                left = (names >= 0) & ~np.isin(names, known)
                rows = np.flatnonzero(left.any(axis=0)[keys[1]])
            for queries, sims in t.steps(asked, rows):
                i, j = _cells(sims > np.float32(over) - 2 * t.off)
                i, j = queries[i], rows[j]
                pair = name(keys[0][i], keys[1][j])
                new = np.flatnonzero((pair >= 0) & ~np.isin(pair, known))
                i, j, pair = i[new], j[new], pair[new]
                v = t.exact(i, j)
                i, j, v, pair = (x[v > over] for x in (i, j, v, pair))
                pairs, first = np.unique(pair, return_index=True)
                known = np.concatenate([known, pairs])
                found.append((i[first], j[first], v[first]))
        return _together(found)

    return choose


def nearest(vectors: DataFrame, queries: DataFrame, k: int, threshold: float | None = None, vec_id: str = "vec_id", vector: str = "e", query_id: str = "query_id", query_vector: str = "qe", keys: Sequence[str] = (), least: Callable[[pa.Table], np.ndarray] | None = None, apart: bool = False) -> DataFrame:
    """(query_id, vec_id, keys, sim): what search finds, for query sets that grow with the rows; in tiles.

    least gives what a row must reach, by its id; apart: a query of the same id as a row doesn't find it.
    """
    rows = vectors.select(vec_id, vector, *keys)
    hits = tiled(rows, queries.select(query_id, query_vector), best_rows(k, keys, threshold if least is None else least, (query_id, vec_id) if apart else None), vec_id, vector, query_id, query_vector)
    best = top_per_group(hits, [query_id, *keys], [F.col("sim").desc(), F.col(vec_id)], k)
    return best if threshold is None else best.where(F.col("sim") >= threshold)


def scored(vectors: DataFrame, queries: DataFrame, vec_id: str = "vec_id", vector: str = "e", query_id: str = "query_id", query_vector: str = "qe", digits: int = 6) -> DataFrame:
    """Every row against every query of a stated set: (query_id, the row's columns, sim).

    The set is counted; up to QUERY_BLOCK queries are broadcast, more are dealt into
    blocks by hash, each broadcast in a pass of its own.
    """
    blocks = -(-queries.count() // QUERY_BLOCK) or 1
    part = F.pmod(F.xxhash64(query_id), F.lit(blocks))
    rows = vectors.where(F.col(vector).isNotNull()).withColumn("__unit", normalised(F.col(vector)))  # lengths once a row, not once a pair
    if blocks > 1:  # each block of queries is a pass over the rows
        rows = reliable(rows)
    asked = queries.select(query_id, normalised(F.col(query_vector)).alias("__asked"))
    passes = [rows.crossJoin(F.broadcast(asked.where(part == i))) for i in range(blocks)]
    whole = reduce(DataFrame.unionByName, passes)
    return whole.withColumn("sim", F.round(dot(F.col("__unit"), F.col("__asked")), digits)).drop("__unit", "__asked")


def search(vectors: DataFrame, queries: DataFrame, k: int, threshold: float | None = None, vec_id: str = "vec_id", keys: Sequence[str] = (), **names) -> DataFrame:
    """The k most similar rows of each query (and each of keys); the threshold is applied after the limit."""
    hits = scored(vectors, queries, vec_id=vec_id, **names)
    best = top_per_group(hits, [names.get("query_id", "query_id"), *keys], [F.col("sim").desc(), F.col(vec_id)], k)
    return best if threshold is None else best.where(F.col("sim") >= threshold)


def search_best(vectors: DataFrame, queries: DataFrame, k: int, threshold: float, vec_id: str = "vec_id", **names) -> DataFrame:
    """Best similarity over the queries of each row found by any of them."""
    hits = nearest(vectors, queries, k, threshold, vec_id, **names)
    return hits.groupBy(vec_id).agg(F.max("sim").alias("sim"))


def rerank(hits: DataFrame, signals: Mapping[str, Column], weights: Mapping[str, float], floor: float = 0.0, similarity: str = "sim", episode: str | None = None, channel: str | None = None, per_channel: int | None = None, row_id: str = "segment_id", bonus: Column | None = None) -> DataFrame:
    """Floor, weighted score, one row an episode, a few a channel; adds final_score."""
    score = S.weighted(signals, weights) + (bonus if bonus is not None else F.lit(0.0))
    out = hits.where(F.col(similarity) >= floor).withColumn("final_score", F.round(score, 6))
    order = [F.col("final_score").desc(), F.col(row_id)]
    if episode:
        out = top_per_group(out, [episode], order)
    if channel and per_channel:
        out = top_per_group(out, [channel], order, per_channel)
    return out


def select_top(df: DataFrame, score: str, row_id: str, n: int) -> DataFrame:
    return top(df, [F.col(score).desc(), F.col(row_id)], n)


def _greedy(table: pa.Table, score: str, vector: str, row_id: str, n: int, weight: float) -> pa.Table:
    """(__uid, picked): diverse's choice from one group that fits a task; sums in the order that dot takes."""
    keys = [(score, "descending"), (row_id, "ascending"), ("__uid", "ascending")]  # ties: the better score, then the smaller id
    table = table.take(pc.sort_indices(table, sort_keys=keys, null_placement="at_start"))
    static = np.asarray(table.column(score).cast(pa.float64()))
    x = np.ascontiguousarray(np.asarray(table.column(vector).combine_chunks().flatten()).reshape(len(table), -1).T)
    left, nearest, chosen = np.ones(len(table), bool), None, []
    for _ in range(min(n, len(table))):
        gain = static + (0.0 if nearest is None else weight * (1 - nearest))
        best = int(np.where(left, gain, -np.inf).argmax())
        left[best] = False
        chosen.append(best)
        near = np.zeros(len(table))
        for line in x:
            near += line * line[best]
        nearest = near if nearest is None else np.maximum(nearest, near)
    return pa.table({"__uid": table.column("__uid").take(pa.array(chosen, pa.int64())), "picked": pa.array(range(1, len(chosen) + 1), pa.int32())})


def diverse(df: DataFrame, score: str, vector: str, row_id: str, n: int, weight: float = 0.5, keys: Sequence[str] = (), small_whole: bool = True, at_once: int = GROUP_AT_ONCE) -> DataFrame:
    """Greedy: the best static score first, then static score + weight * (1 - largest dot product with the chosen).

    All rows are candidates. A group of at most at_once rows, all of plain numbers, is
    chosen from in one task. For others a pass for each place takes every group's best row
    and updates the largest dot products, so that no task holds a group; each is one job that
    ends in a reliable checkpoint. Only ids, scores and vectors go through this; other
    columns are joined to what was chosen. Groups of at most n rows come back whole, rows without a vector
    too, unless small_whole is false. Adds picked, the place in the choice, from 1.
    """
    group = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    rows = df.withColumn("__group", F.to_json(group, {"ignoreNullFields": "false"}))
    known = lambda x: F.coalesce(F.abs(x.cast("double")) < 1e100, F.lit(False))
    wide = F.col(vector).isNotNull()
    plain = F.coalesce(F.bool_and(F.when(wide, F.forall(vector, known) & known(F.col(score)))), F.lit(True))
    one = F.coalesce(F.min(F.when(wide, F.size(vector))) == F.max(F.when(wide, F.size(vector))), F.lit(True))
    here = (F.count(F.lit(1)) <= at_once) & plain & one
    sizes = rows.groupBy("__group").agg(F.count(F.lit(1)).alias("__size"), here.alias("__here"))
    rows = reliable(rows.join(sizes, "__group")).withColumn("__uid", F.monotonically_increasing_id())
    whole = (F.col("__size") <= n) if small_whole else F.lit(False)
    small = rows.where(whole)
    place = F.row_number().over(Window.partitionBy("__group").orderBy(F.col(score).desc(), F.col(row_id)))
    parts = [small.withColumn("picked", place).select(*df.columns, "picked")]
    left = rows.where(~whole & wide).select("__uid", "__group", "__here", F.col(score), *([F.col(row_id)] if row_id != score else []), F.col(vector))
    chosen = left.where("__here").drop("__here").groupBy("__group").applyInArrow(lambda t: _greedy(t, score, vector, row_id, n, weight), "__uid long, picked int")
    left = left.where("not __here").drop("__here")
    if not left.isEmpty():
        left = reliable(left.withColumns({"__nearest": F.lit(None).cast("double"), "picked": F.lit(None).cast("int")}))
        for at in range(1, n + 1):
            gain = F.col(score).cast("double") + F.coalesce(weight * (1 - F.col("__nearest")), F.lit(0.0))
            # min_by of the gain turned round; ties go to the better static score, then to the smaller id
            rank = F.struct((-gain).alias("g"), (-F.col(score)).alias("s"), F.col(row_id).alias("i"), F.col("__uid").alias("u"))
            best = left.where("picked is null").groupBy("__group").agg(F.min_by(F.struct("__uid", vector), rank).alias("__b"))
            joined = left.join(best, "__group", "left")  # no best: the group is used up
            picked = F.when(F.col("picked").isNull() & (F.col("__uid") == F.col("__b.__uid")), at).otherwise(F.col("picked"))
            near = F.when(F.col("__b").isNotNull(), F.greatest(F.col("__nearest"), dot(F.col(vector), F.col("__b")[vector]))).otherwise(F.col("__nearest"))
            left = reliable(joined.withColumns({"picked": picked, "__nearest": near}).drop("__b"))
        chosen = chosen.unionByName(left.where("picked is not null").select("__uid", "picked"))
    parts.append(rows.join(chosen, "__uid").select(*df.columns, "picked"))
    return reduce(DataFrame.unionByName, parts)


def farthest_points(df: DataFrame, vector: str, row_id: str, n: int, keys: Sequence[str]) -> DataFrame:
    """Per group, n rows each least similar to those chosen before; starts at the least id. Adds picked."""
    flat = df.withColumns({"__unit": normalised(F.col(vector)), "__same": F.lit(0.0)})
    return diverse(flat, "__same", "__unit", row_id, n, 1.0, keys, small_whole=False).drop("__unit", "__same")
