"""Near-duplicate vectors by E8 lattice hashing.

A unit vector is rotated by fixed random orthonormal matrices and cut into blocks of eight
coordinates, each scaled and decoded to the nearest point of the E8 lattice; BLOCKS of them
make the key of one table, so that two unrelated vectors share a key by chance about once
in ten million (64 dimensions, cosine 0.98). A vector is indexed under its own cells and
probes the PROBES keys nearest to it, made of each block's own cell and of neighbouring
lattice points. Two unit vectors of cosine t are sqrt(2 - 2t) apart; the scale makes the
average distance of their projections STEP. A candidate in any table is verified by its
cosine in double precision. Keys also carry the signs of SIGNS random projections: a pair
that differs in more of them than a pair at the cosine would, by DEVIATIONS standard
deviations, is left out before vectors are fetched (for 0.98, a chance below 1e-9 of
leaving out a pair that the cosine would keep).
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomcast.llm.common import components, cut, spread_join

TABLES, BLOCKS, PROBES, STEP, SEED = 12, 3, 8, 0.35, 20240131
#: Cells of each block that probes are made of.
CELLS = 4
SIGNS, DEVIATIONS = 128, 8.0
_MIX = np.uint64(0x9E3779B97F4A7C15)


def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = [0.0] * 8
            v[i], v[j] = a, b
            out.append(v)
    out += [list(v) for v in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(out)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(axis=1).astype(np.int64) & 1)
    if len(odd):
        off = x[odd] - near[odd]
        k = np.abs(off).argmax(axis=1)
        near[odd, k] += np.where(off[np.arange(len(odd)), k] >= 0, 1.0, -1.0)
    return near


def decode_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 point to each row of eight."""
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(axis=1) < ((x - whole) ** 2).sum(axis=1)
    return np.where(closer[:, None], half, whole)


def pack_cells(points: np.ndarray) -> np.ndarray:
    """Lattice points as 64-bit keys: twice each coordinate, a byte each."""
    return np.ascontiguousarray((2 * points).astype(np.int8)).view("<i8").reshape(-1)


class Lattice:
    def __init__(self, dim: int, cosine: float, tables: int = TABLES, seed: int = SEED) -> None:
        rng, cols, parts = np.random.default_rng(seed), 8 * BLOCKS * tables, []
        while sum(p.shape[1] for p in parts) < cols:
            q, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
            parts.append(q if dim >= 8 else np.pad(q, ((0, 0), (0, 8 - dim))))
        turn = np.concatenate(parts, axis=1)[:, :cols]
        apart = max(np.sqrt(max(0.0, 2 - 2 * cosine)), 1e-3)
        self.turn = turn * STEP * np.sqrt(max(dim, 8) / 8) / apart
        self.tables, self.near = tables, np.vstack([np.zeros((1, 8)), neighbours()])
        self.lengths = (self.near**2).sum(axis=1)
        self.planes = rng.standard_normal((dim, SIGNS))

    def signs(self, unit: np.ndarray) -> np.ndarray:
        """The signs of the random projections as two signed 64-bit numbers a row."""
        return np.packbits(unit @ self.planes > 0, axis=1).view("<i8")

    def _cells(self, unit: np.ndarray, block: int, probing: bool) -> tuple[np.ndarray, np.ndarray]:
        """(keys, squared distances) of the cells nearest to each vector in a block, the nearest first."""
        x = unit @ self.turn[:, 8 * block : 8 * block + 8]
        at = decode_e8(x)
        if not probing:
            return pack_cells(at)[:, None], np.zeros((len(x), 1))
        rest = x - at
        far = (rest**2).sum(axis=1)[:, None] + self.lengths - 2.0 * (rest @ self.near.T)
        which = np.argpartition(far, CELLS - 1, axis=1)[:, :CELLS]
        cells = pack_cells((at[:, None] + self.near[which]).reshape(-1, 8)).reshape(-1, CELLS)
        return cells, np.take_along_axis(far, which, axis=1)

    def keys(self, unit: np.ndarray, probing: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, table, key) of unit vectors."""
        n, rows, tables, keys = len(unit), [], [], []
        for t in range(self.tables):
            key, far = np.zeros((n, 1), np.uint64), np.zeros((n, 1))
            for block in range(BLOCKS * t, BLOCKS * (t + 1)):
                cells, d = self._cells(unit, block, probing)
                far = (far[:, :, None] + d[:, None, :]).reshape(n, -1)
                mixed = (key[:, :, None] ^ cells.view(np.uint64)[:, None, :]) * _MIX
                key = (mixed ^ (mixed >> np.uint64(29))).reshape(n, -1)
            if probing and key.shape[1] > PROBES:
                best = np.argpartition(far, PROBES - 1, axis=1)[:, :PROBES]
                key = np.take_along_axis(key, best, axis=1)
            rows.append(np.repeat(np.arange(n), key.shape[1]))
            tables.append(np.full(key.size, t, dtype=np.int32))
            keys.append(key.reshape(-1).view(np.int64))
        return np.concatenate(rows), np.concatenate(tables), np.concatenate(keys)


def most_signs(cosine: float) -> int:
    """Differing signs beyond which a pair is surely below the cosine."""
    p = float(np.arccos(np.clip(cosine, -1, 1)) / np.pi)
    return int(np.ceil(SIGNS * p + DEVIATIONS * np.sqrt(SIGNS * p * (1 - p)) + 2))


def usable(docs: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id, label, vec): vec as bytes, null where the vector or its label can't link; -0 counts as 0."""
    kind = docs.schema[vec_col].dataType
    dtype = "<f4" if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else "<f8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs, labels = batch.column(2), batch.column(1)
            flat = vecs.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False) + 0.0
            lengths = vecs.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends, out = np.cumsum(lengths), []
            for a, b, known in zip((ends - lengths).tolist(), ends.tolist(), labels.is_valid().to_pylist(), strict=True):
                v = flat[a:b]
                out.append(v.astype(dtype).tobytes() if known and np.isfinite(v).all() and v.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), labels, pa.array(out, pa.binary())], names=["id", "label", "vec"])

    picked = docs.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("v"))
    ids, labels = docs.schema[id_col].dataType.simpleString(), docs.schema[label_col].dataType.simpleString()
    return picked.mapInArrow(run, f"id {ids}, label {labels}, vec binary"), dtype


def near_duplicates(docs: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", cosine: float = 0.98) -> DataFrame:
    """(id, n_links, component_id, kept), one row per row of docs.

    Only vectors of one label and length are compared. Equal vectors are combined first
    and counted, so copies are never expanded into pairs; n_links counts the other rows
    linked directly, copies included. Rows whose label is null, or whose vector is null,
    empty, zero or holds null or non-finite components, link with nothing and are their
    own component. A null id never becomes a component's id; such rows are not kept. Very
    long vectors are hashed by their projections and verified whole. An empty table
    gives an empty result; other columns are ignored, whatever their names.
    """
    rows, dtype = usable(docs, id_col, vec_col, label_col)
    rows = cut(rows)
    id_type = docs.schema[id_col].dataType
    classes = rows.where("vec is not null").groupBy("label", "vec").agg(F.min("id").alias("least_id"), F.count(F.lit(1)).alias("n"))
    classes = cut(classes.withColumn("cid", F.monotonically_increasing_id()))

    def keyed(probing: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            made: dict[int, Lattice] = {}
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    part = batch.slice(at, 1024)
                    vecs = [np.frombuffer(v, dtype).astype(float) for v in part.column(1).to_pylist()]
                    cids = part.column(0).to_numpy()
                    for dim in {len(v) for v in vecs}:
                        which = np.array([i for i, v in enumerate(vecs) if len(v) == dim])
                        unit = np.array([vecs[i] for i in which])
                        unit /= np.abs(unit).max(axis=1, keepdims=True)  # no overflow in the norm
                        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                        if dim not in made:
                            made[dim] = Lattice(dim, cosine)
                        row, table, cell = made[dim].keys(unit, probing)
                        picked, signs = pa.array(which[row]), made[dim].signs(unit)[row]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(cids[which[row]]), part.column(2).take(picked), pa.array(table), pa.array(cell), pa.array(np.full(len(row), dim, np.int32)), pa.array(signs[:, 0]), pa.array(signs[:, 1])],
                            names=["cid", "label", "tab", "cell", "dim", "s", "t"],
                        )

        return classes.select("cid", "vec", "label").mapInArrow(run, f"cid long, label {docs.schema[label_col].dataType.simpleString()}, tab int, cell long, dim int, s long, t long")

    on = ["label", "tab", "cell", "dim"]
    probes = keyed(True).withColumnsRenamed({"cid": "a", "s": "s1", "t": "t1"})
    apart = F.bit_count(F.col("s").bitwiseXOR(F.col("s1"))) + F.bit_count(F.col("t").bitwiseXOR(F.col("t1")))
    pairs = probes.join(keyed(False).withColumnRenamed("cid", "b"), on).where((F.col("a") != F.col("b")) & (apart <= most_signs(cosine)))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    vecs = classes.select("cid", "vec")
    held = pairs.join(vecs.toDF("a", "va"), "a").join(vecs.toDF("b", "vb"), "b").select("a", "b", "va", "vb")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                x, y = (part.column(i).to_pylist() for i in (2, 3))
                sizes, good = np.array([len(v) for v in x]), []
                for size in np.unique(sizes):  # the two of a pair have one length
                    which = np.flatnonzero(sizes == size)
                    u, v = (np.frombuffer(b"".join([z[i] for i in which]), dtype).reshape(len(which), -1).astype(float) for z in (x, y))
                    u, v = (z / np.abs(z).max(axis=1, keepdims=True) for z in (u, v))  # no overflow in the products
                    cos = (u * v).sum(axis=1) / np.sqrt((u * u).sum(axis=1) * (v * v).sum(axis=1))
                    good.append(which[cos >= cosine])
                picked = pa.array(np.concatenate(good) if good else [], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0).take(picked), part.column(1).take(picked)], names=["a", "b"])

    linked = cut(held.mapInArrow(verify, "a long, b long"))
    sizes = classes.select("cid", "n", "least_id")
    both = linked.unionByName(linked.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.join(sizes.select(F.col("cid").alias("b"), "n"), "b").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("near"))
    found = components(linked).withColumnRenamed("node", "cid").join(sizes, "cid")
    least = found.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of = found.select("cid", "component").join(least, "component").select("cid", "component_id")
    known = classes.join(degree, "cid", "left").join(of, "cid", "left").select(
        "label", "vec", (F.col("n") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"), F.coalesce("component_id", "least_id").alias("component_id")
    )
    able, other = rows.where("vec is not null"), rows.where("vec is null")
    out = spread_join(able, known, ["label", "vec"]).select("id", "n_links", "component_id")
    out = out.unionByName(other.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").cast(id_type).alias("component_id")))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
