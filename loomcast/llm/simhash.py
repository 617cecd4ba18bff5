"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits, each read as a word
of the perfect binary Golay code [23, 12, 7]: every word is within three bits of
exactly one codeword. For a word x, K(x) holds the indices of the codewords to which x
and its 23 one-bit neighbours decode: one to six values. Two facts carry the search:

* words at most two bits apart share a member of K (decode a word between them);
* words at most one bit apart satisfy decode(y) in K(x).

Three differing bits over three segments leave two cases. If some segment is equal,
then for one of the cyclic pairs (A,B), (B,C), (C,A) the first is equal and the second
differs in at most two bits: key = the first segment itself and a member of K(second).
Otherwise every segment differs in exactly one bit: key = a member of K(A), decode(B),
a member of K(C) on the probing side against decode(A), a member of K(B), decode(C) on
the indexed side. So no pair within three bits is missed; the join then verifies the
true distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import components, cut, spread_join

#: Low bit and width of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Generator polynomial x^11+x^10+x^6+x^5+x^4+x^2+1 of the binary Golay code.
GENERATOR = 0xC75
SHINGLES_AT_ONCE = 1 << 15


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words by the generator polynomial, 11 bits."""
    rest = words.astype(np.int64)
    for bit in range(22, 10, -1):
        rest = np.where((rest >> bit) & 1, rest ^ (GENERATOR << (bit - 11)), rest)
    return rest


def _leaders() -> np.ndarray:
    """The error of at most three bits that each syndrome stands for."""
    single = [1 << i for i in range(23)]
    errors = [0, *single]
    errors += [single[i] | single[j] for i in range(23) for j in range(i)]
    errors += [single[i] | single[j] | single[k] for i in range(23) for j in range(i) for k in range(j)]
    errors = np.array(errors, dtype=np.int64)
    table = np.zeros(2048, dtype=np.int64)
    table[_syndromes(errors)] = errors
    return table


class Golay:
    """Decodes 23-bit words to 12-bit codeword indices."""

    def __init__(self) -> None:
        self.leaders = _leaders()

    def decode(self, words: np.ndarray) -> np.ndarray:
        return (words ^ self.leaders[_syndromes(words)]) >> 11

    def neighbourhood(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, index) for each distinct member of K(word)."""
        flips = np.array([0] + [1 << i for i in range(23)], dtype=np.int64)
        keys = np.sort(self.decode(words[:, None] ^ flips[None, :]), axis=1)
        new = np.ones(keys.shape, dtype=bool)
        new[:, 1:] = keys[:, 1:] != keys[:, :-1]
        rows, cols = np.nonzero(new)
        return rows, keys[rows, cols]


def _pairs_of(left: tuple, right: tuple, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every member of K(left) with every member of K(right), row by row."""
    (lrow, lkey), (rrow, rkey) = left, right
    rcount = np.bincount(rrow, minlength=n)
    rstart = np.concatenate([[0], np.cumsum(rcount)[:-1]])
    times = rcount[lrow]
    rows = np.repeat(lrow, times)
    within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    return rows, np.repeat(lkey, times), rkey[rstart[rows] + within]


def fuzzy_keys(fingerprints: np.ndarray, golay: Golay, probing: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) for signed 64-bit fingerprints; key holds the table's number in its high bits."""
    fp = fingerprints.view(np.uint64)
    seg = [((fp >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64) for low, width in SEGMENTS]
    near = [golay.neighbourhood(s) for s in seg]
    rows, keys = [], []
    for table, (exact, fuzzy) in enumerate(((0, 1), (1, 2), (2, 0))):
        row, key = near[fuzzy]
        rows.append(row)
        keys.append((np.int64(table) << 36) | (seg[exact][row] << 12) | key)
    if probing:
        row, a, c = _pairs_of(near[0], near[2], len(fp))
        b = golay.decode(seg[1])[row]
    else:
        row, b = near[1]
        a, c = golay.decode(seg[0])[row], golay.decode(seg[2])[row]
    rows.append(row)
    keys.append((np.int64(3) << 36) | (a << 24) | (b << 12) | c)
    return np.concatenate(rows), np.concatenate(keys)


def simhash(text: bytes, width: int = 3, seed: int = 42) -> int:
    """Fingerprint of one whole text: a bit is set if it is set in over half the shingles' XXH64."""
    import xxhash

    words = text.lower().split()  # bytes: only A-Z are lowered, only ASCII white space splits
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return digest(joined, seed)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, n = ends - lengths, len(words) - width + 1
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        to = min(n, at + SHINGLES_AT_ONCE)
        spans = zip(starts[at:to].tolist(), ends[at + width - 1 : to + width - 1].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp long): the signed 64-bit SimHash of each whole text; a null text is empty and has 0."""
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([simhash(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], names=[id_col, "fp"])

    picked = docs.select(F.col(id_col), F.col(text_col).cast("binary").alias(text_col))
    return picked.mapInArrow(run, f"`{id_col}` {id_type.simpleString()}, fp long")


def links(classes: DataFrame, max_bits: int = 3) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints at most max_bits (0 to 3) apart; classes holds each fp once."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the Golay keys find distances up to 3")

    def keyed(probing: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            golay = Golay()
            for batch in batches:
                for at in range(0, batch.num_rows, 4096):
                    fp = batch.column(0).slice(at, 4096).to_numpy(zero_copy_only=False)
                    rows, keys = fuzzy_keys(fp, golay, probing)
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fp[rows])], names=["key", "fp"])

        return classes.select("fp").mapInArrow(run, "key long, fp long")

    left = keyed(True).select("key", F.col("fp").alias("a"))
    right = keyed(False).select("key", F.col("fp").alias("b"))
    # Tables 0 to 2 hold each pair both ways round; table 3 may hold it one way only.
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    once = (F.col("a") < F.col("b")) | ((left.key >= F.lit(3 << 36)) & (F.col("a") != F.col("b")))
    found = left.join(right, (left.key == right.key) & apart & once)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 3) -> DataFrame:
    """(id, fp, component_id): one row per row of docs.

    Equal fingerprints form a class (combined before any shuffle); classes at most
    max_bits apart are linked, and component_id is the smallest id reachable. Texts
    without words have fingerprint 0 and are linked like any other. A row whose id is
    null gets its class's component (null if no row reachable has an id). Repeated rows
    and repeated ids stay separate rows; very long texts are hashed whole, part by part; an
    empty table gives an empty result. Other columns are ignored, whatever their names.
    """
    rows = cut(fingerprints(docs, id_col, text_col))
    classes = cut(rows.groupBy("fp").agg(F.min(id_col).alias("least_id")))
    found = components(links(classes, max_bits)).withColumnRenamed("node", "fp")
    groups = found.join(classes, "fp")
    least = groups.groupBy("component").agg(F.min("least_id").alias("component_id"))
    linked = groups.select("fp", "component").join(least, "component").select("fp", "component_id")
    of = classes.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "least_id").alias("component_id"))
    return spread_join(rows, of, ["fp"]).select(id_col, "fp", "component_id")


def fingerprint_hex(col: str = "fp") -> F.Column:
    return F.lower(F.lpad(F.hex(F.col(col)), 16, "0"))
