"""Byte-level BPE by a global shuffle of distinct words.

The split pattern never joins characters across the end of a run of white space: a
text's pre-tokens are those of its words, a word being a run of other characters with
the one space before it, if that is a space, and of the white space between. So a text
is the sequence of its words' ids.

Each input partition is read in blocks of bounded size. A block yields its distinct
words, dealt by a hash of the word into buckets that are shuffled over the whole input,
so that every distinct word is encoded once, by one task; and, for its documents, the
positions of those words. Words, ids and positions travel as compressed columns, a row
for each block and bucket. The ids are joined back by block, each block's texts
reassembled by position, and decoded against the table of token bytes, which has one row
per token of the vocabulary.

Both readings of a partition sort it by id and text first, so that a block holds the same
rows each time, in whatever order a shuffle brings them (files and checkpoints, which come
in one order, need no sort); a digest of the block's content in
its key makes other rows an error instead of a wrong result. Blocks, buckets and the
partitions of both shuffles are as many as the input's characters ask for.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_CHARS = 6_000_000
#: Characters of input for each bucket of words and each partition of blocks.
PART_CHARS = 64_000_000
DIFFERENT = "a block's two readings differ: the input must give the same rows each time"
#: White space as the pattern's \s takes it (str.isspace takes four characters more).
_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_WORDS = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")


def words_of(text: str) -> list[str]:
    """Words and white space whose pre-tokens, put together, are the text's."""
    return _WORDS.findall(text)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def encoding(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})


def _squeeze(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(data)


def _expand(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def _planes(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, compressed byte plane by byte plane."""
    return _squeeze(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _numbers(planes: bytes) -> np.ndarray:
    raw = np.frombuffer(_expand(planes), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").reshape(-1)


def _blocks(batches: Iterator[pa.RecordBatch], positions: bool, block_chars: int):
    """(key, distinct words by first appearance, ids, words per text, positions) of each block."""
    def start():
        index: dict = defaultdict()
        index.default_factory = index.__len__
        return index, [], [], [], hashlib.blake2b(digest_size=8), 0

    index, ids, counts, found, digest, chars = start()
    for batch in batches:
        for doc_id, value in zip(batch.column(0), batch.column(1), strict=True):
            text = value.as_py()  # one text at a time: a batch may hold many long ones
            words = words_of(text or "")
            at = list(map(index.__getitem__, words)) if positions else index.update(dict.fromkeys(words))
            if positions:
                found.append(np.array(at, dtype=np.uint32))
            ids.append(doc_id)
            counts.append(len(words))
            digest.update((text or "").encode())
            digest.update(f"|{doc_id}|".encode())
            chars += len(text or "")
            if chars >= block_chars:
                made = int.from_bytes(digest.digest(), "little", signed=True), index, ids, counts, found
                index, ids, counts, found, digest, chars = start()
                yield made
                del made
    if ids:
        yield int.from_bytes(digest.digest(), "little", signed=True), index, ids, counts, found


def distinct_words(docs: DataFrame, id_col: str, text_col: str, block_chars: int = BLOCK_CHARS, buckets: int = 64) -> DataFrame:
    """(bucket, block, at, sizes, words): each block's distinct words by bucket.

    at numbers a block's words by first appearance (as differences), sizes are their
    lengths in bytes and words the bytes themselves.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, index, *rest in _blocks(batches, False, block_chars):
            held: list[tuple[list[int], list[bytes]]] = [([], []) for _ in range(buckets)]
            for at, word in enumerate(index):
                raw = word.encode()
                spot = held[zlib.crc32(raw) % buckets]
                spot[0].append(at)
                spot[1].append(raw)
            rows = [(b, key, _planes(np.diff(ats, prepend=0)), _planes(np.fromiter(map(len, raws), np.int64, len(raws))), _squeeze(b"".join(raws))) for b, (ats, raws) in enumerate(held) if ats]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), *[pa.binary()] * 3), strict=True)], names=["bucket", "block", "at", "sizes", "words"])
            del index, rest, held, rows, columns  # before the next block is read

    return docs.select(id_col, text_col).mapInArrow(run, "bucket int, block long, at binary, sizes binary, words binary")


def word_positions(docs: DataFrame, id_col: str, text_col: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(block, doc_ids, counts, positions): each block's texts as numbers of its words."""
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, index, ids, counts, found in _blocks(batches, True, block_chars):
            held = pa.array([[x.as_py() for x in ids]], pa.list_(ids[0].type))
            planes = [_planes(np.array(counts, dtype=np.uint32)), _planes(np.concatenate(found))]
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), held, pa.array([planes[0]]), pa.array([planes[1]])], names=["block", "doc_ids", "counts", "positions"])
            del index, ids, counts, found, held, planes

    return docs.select(id_col, text_col).mapInArrow(run, f"block long, doc_ids array<{id_type.simpleString()}>, counts binary, positions binary")


def encode_words(words: DataFrame, path: str, pattern: str, parts: int) -> DataFrame:
    """(block, at, sizes, ids): words shuffled by bucket, each distinct one encoded once.

    A task takes its buckets one after the other and remembers one bucket's words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib, known, now = encoding(path, pattern).encode_ordinary, {}, None
        for batch in batches:
            rows = []
            for bucket, block, at, sizes, blob in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if bucket != now:
                    known, now = {}, bucket
                raw, start, out = _expand(blob), 0, []
                for size in _numbers(sizes).tolist():
                    word = raw[start : start + size]
                    start += size
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = array("I", lib(word.decode())).tobytes()
                    out.append(ids)
                counts = np.fromiter(map(len, out), np.int64, len(out)) // 4
                rows.append((block, at, _planes(counts), _planes(np.frombuffer(b"".join(out), "<u4"))))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), *[pa.binary()] * 3), strict=True)], names=["block", "at", "sizes", "ids"])

    return words.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(run, "block long, at binary, sizes binary, ids binary")


def _gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[s : s + n] for each (s, n), put together."""
    return flat[np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS, buckets: int | None = None, in_order: bool = False) -> DataFrame:
    """(id, ids): one row per row of docs; ids are little-endian unsigned 32-bit integers.

    Equal to encoding each match of pattern in the whole text, without special tokens;
    pattern must treat white space as the module says. A null text is empty and has no
    ids; a very long one is a block of its own. Repeated rows stay; an empty table gives an
    empty result; other columns are ignored, whatever their names. buckets bounds the
    words that a task remembers, a bucket's share of all distinct words; by default there
    is one for each PART_CHARS characters, and at least one a shuffle partition. in_order
    says that docs come from files or a checkpoint and so in the same order each time.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-(docs.agg(F.sum(F.length("text"))).first()[0] or 0) // PART_CHARS))
    buckets = buckets or parts
    docs = docs if in_order else docs.sortWithinPartitions("id", "text")
    id_type = docs.schema["id"].dataType.simpleString()
    numbered = encode_words(distinct_words(docs, "id", "text", block_chars, buckets), path, pattern, min(parts, buckets))
    nothing = F.lit(None)
    rows = numbered.withColumns({"doc_ids": nothing.cast(f"array<{id_type}>"), "counts": nothing.cast("binary"), "positions": nothing.cast("binary")}).unionByName(
        word_positions(docs, "id", "text", block_chars).withColumns({c: nothing.cast("binary") for c in ("at", "sizes", "ids")})
    )

    def assemble(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        whole = table.filter(pa.compute.is_valid(table["positions"]))
        words = table.filter(pa.compute.is_valid(table["at"]))
        parts: dict[bytes, tuple] = {}  # blocks of equal content share a key: their words come once for each
        for at, sizes, ids in zip(*[words[c].to_pylist() for c in ("at", "sizes", "ids")], strict=True):
            if at not in parts:
                parts[at] = (np.cumsum(_numbers(at).astype(np.int64)), _numbers(sizes).astype(np.int64), _numbers(ids))
        empty = np.empty(0, np.int64)
        at, sizes, flat = (np.concatenate([p[i] for p in parts.values()] or [empty]) for i in range(3))
        order = np.argsort(at)
        starts, lengths = (np.cumsum(sizes) - sizes)[order], sizes[order]
        n = len(at)
        complete = n == 0 or at[order[-1]] == n - 1
        ids, out = [], []
        for row in range(len(whole)):
            positions = _numbers(whole["positions"][row].as_py())
            if not complete or n != (int(positions.max()) + 1 if len(positions) else 0):
                raise RuntimeError(DIFFERENT)
            counts = _numbers(whole["counts"][row].as_py()).astype(np.int64)
            ends = np.cumsum(counts)
            ids.append(whole["doc_ids"][row].values)
            for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True):
                p = positions[a:b]
                out.append(_gather(flat, starts[p], lengths[p]).tobytes())
        if not ids:
            raise RuntimeError(DIFFERENT)
        return pa.table({id_col: pa.chunked_array(ids), "ids": pa.array(out, pa.binary())})

    return rows.repartition(parts, "block").groupBy("block").applyInArrow(assemble, f"`{id_col}` {id_type}, ids binary")


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """encoded with the bytes of its ids in column out, which replaces one of that name.

    The token-byte table has a row per token of the vocabulary. Null ids give null, empty
    ones nothing; very long ones are decoded whole; an empty table gives an empty result.
    """
    encoded = encoded.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load_ranks(path)
        table = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            table[i] = token
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col))
            texts = [b"".join([table[i] for i in np.frombuffer(x.as_buffer(), "<u4").tolist()]) if x.is_valid else None for x in ids]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=[*batch.schema.names, out])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{schema}, `{out}` binary")
