"""Token ids as wavelet matrices: a shard's file answers for its tokens without being unpacked.

A shard holds the ids of whole documents, in the order of their ids. Its payload has a
bit-plane for each bit of an id, the highest first; each plane orders the ids by the plane
before, those with a 0 first, so that planes become runs as they go down. A plane is cut
into chunks, compressed where that helps, and a directory tells the ones before each chunk
(rank) and where it lies: a token at a place, a token's count in a range and all places of
a token follow from the few chunks on its path.

Documents are sorted once, by a range shuffle on the id; each task encodes its texts and
closes a shard when it is full. Spark writes a shard as one Parquet file of one row, so
that any store and its commits serve, and reads only the columns that are asked for.
"""

from __future__ import annotations

import functools
import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomcast.llm.bpe import words_of
from loomcast.llm.common import free_name, worker_keeps
from loomcast.llm.packing import byte_letters

#: A shard is closed at so many ids, after the document that reaches it.
SHARD_TOKENS = 1_000_000
CHUNK = 1 << 15
_HEAD = struct.Struct("<4sIQ")
_MAGIC = b"WVM1"
#: Words a worker remembers, in about 200 MB; beyond it the table starts anew.
REMEMBERED = 1_000_000
_TOUCHING = re.compile(r"\s\s")
#: A Latin word and marks after it: two pre-tokens at most, the word with the space before it.
_PLAIN = re.compile("([A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f]+)([^\\w\\s]*)")


def packed(ids: np.ndarray, bits: int) -> bytes:
    """The payload of a sequence of ids below 2 ** bits, of fewer than 2 ** 32 ids."""
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=3).compress
    kind = np.uint16 if bits <= 16 else np.uint32
    now, n = ids.astype(kind), len(ids)
    zeros, ones, sizes, chunks = [], [], [], []
    for bit in reversed(range(bits)):
        plane = (now & kind(1 << bit)) != 0
        octets = np.packbits(plane, bitorder="little")
        starts, raw = range(0, len(octets), CHUNK // 8), octets.tobytes()
        held = np.add.reduceat(np.bitwise_count(octets), starts, dtype=np.int64) if n else np.zeros(0, np.int64)
        ones.append(np.cumsum(held) - held)
        for at in starts:
            part = raw[at : at + CHUNK // 8]
            small = squeeze(part)
            chunks.append(small if len(small) < len(part) else part)
            sizes.append(len(chunks[-1]))
        zeros.append(n - int(held.sum()))
        now = np.concatenate([np.compress(~plane, now), np.compress(plane, now)])
    directory = np.array(zeros, "<u4").tobytes() + np.concatenate(ones).astype("<u4").tobytes() + np.array(sizes, "<u4").tobytes()
    return _HEAD.pack(_MAGIC, bits, n) + directory + b"".join(chunks)


class Wavelet:
    """Access to a payload; chunks are unpacked as they are met, and the last ones kept."""

    def __init__(self, payload: bytes) -> None:
        magic, self.bits, self.n = _HEAD.unpack_from(payload)
        import zstandard

        if magic != _MAGIC:
            raise ValueError("not a wavelet matrix")
        self._expand = zstandard.ZstdDecompressor().decompress
        self.payload, per = payload, -(-self.n // CHUNK)
        numbers = np.frombuffer(payload, "<u4", self.bits * (1 + 2 * per), _HEAD.size).astype(np.int64)
        self.zeros, ones, sizes = np.split(numbers, [self.bits, self.bits * (1 + per)])
        self.ones = ones.reshape(self.bits, per)
        ends = _HEAD.size + 4 * len(numbers) + np.cumsum(sizes)
        self.spans = np.stack([ends - sizes, ends], axis=1).reshape(self.bits, per, 2)
        self._bits = functools.lru_cache(maxsize=256)(self._unpacked)

    def _octets(self, level: int, chunk: int) -> bytes:
        start, end = self.spans[level, chunk].tolist()
        part = self.payload[start:end]
        return self._expand(part) if len(part) < -(-min(CHUNK, self.n - chunk * CHUNK) // 8) else part

    def _unpacked(self, level: int, chunk: int) -> np.ndarray:
        return np.unpackbits(np.frombuffer(self._octets(level, chunk), np.uint8), count=min(CHUNK, self.n - chunk * CHUNK), bitorder="little")

    def ids(self) -> np.ndarray:
        """All ids: the planes put back from the lowest up."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        now = np.zeros(self.n, kind)
        for level in reversed(range(self.bits)):
            raw = b"".join([self._octets(level, c) for c in range(self.ones.shape[1])])
            plane = np.unpackbits(np.frombuffer(raw, np.uint8), count=self.n, bitorder="little").view(bool)
            before = np.empty_like(now)
            before[np.concatenate([np.flatnonzero(~plane), np.flatnonzero(plane)])] = now
            now = before | plane.astype(kind) << kind(self.bits - 1 - level)
        return now

    def _rank(self, level: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bit at each place (0 at the end) and the ones before it."""
        bit, ones = np.zeros(len(at), np.int64), np.full(len(at), self.n - self.zeros[level])
        for chunk in np.unique(at[at < self.n] // CHUNK).tolist():
            mine = np.flatnonzero(at // CHUNK == chunk)
            mine = mine[at[mine] < self.n]
            plane, inside = self._bits(level, chunk), at[mine] - chunk * CHUNK
            upto = np.cumsum(plane, dtype=np.int64)
            bit[mine], ones[mine] = plane[inside], self.ones[level, chunk] + upto[inside] - plane[inside]
        return bit, ones

    def at(self, places: np.ndarray) -> np.ndarray:
        """The ids at places from 0."""
        now, out = np.asarray(places, np.int64), np.zeros(len(places), np.int64)
        for level in range(self.bits):
            bit, ones = self._rank(level, now)
            out = out << 1 | bit
            now = np.where(bit == 1, self.zeros[level] + ones, now - ones)
        return out

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        """Where the token's occurrences in [start, end) lie below the last plane."""
        if token >> self.bits or token < 0:
            return 0, 0
        now = np.array([start, end], np.int64)
        for level in range(self.bits):
            ones = self._rank(level, now)[1]
            now = self.zeros[level] + ones if token >> (self.bits - 1 - level) & 1 else now - ones
        return int(now[0]), int(now[1])

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of token in [start, end)."""
        low, high = self._range(token, start, self.n if end is None else end)
        return high - low

    def places(self, token: int) -> np.ndarray:
        """All places of token, ascending: select, plane by plane upwards."""
        low, high = self._range(token, 0, self.n)
        now = np.arange(low, high)
        for level in reversed(range(self.bits)):
            one = token >> (self.bits - 1 - level) & 1
            wanted = now - self.zeros[level] if one else now  # the so-manieth bit of that kind
            before = self.ones[level] if one else np.arange(self.ones.shape[1]) * CHUNK - self.ones[level]
            chunks = np.searchsorted(before, wanted, "right") - 1
            for chunk in np.unique(chunks).tolist():
                mine = chunks == chunk
                now[mine] = chunk * CHUNK + np.flatnonzero(self._bits(level, chunk) == one)[wanted[mine] - before[chunk]]
        return now


class WordIds:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, equal to the library's; special tokens' strings are text.

    Where no two white-space characters meet, pre-tokens never cross the start of a space,
    so a text's ids are those of its pieces between spaces, each with the space before it;
    elsewhere those of bpe.words_of. The library is asked once for a piece or word; of a
    plain one only its model, as the pre-tokens are clear.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.model, self.letters = self.library.model, byte_letters()
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.stems: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}

    def ids(self, text: str) -> bytes:
        if _TOUCHING.search(text):
            return self._joined(self.words, words_of(text), "")
        first, *rest = text.split(" ")
        return (self._joined(self.words, words_of(first), "") if first else b"") + self._joined(self.pieces, rest, " ")

    def _joined(self, known: dict[str, bytes], parts: list[str], before: str) -> bytes:
        try:
            return b"".join([known[p] for p in parts])
        except KeyError:
            new = [p for p in dict.fromkeys(parts) if p not in known]
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = list(dict.fromkeys(parts))
        for part in new:
            plain = _PLAIN.fullmatch(part) if before else None
            known[part] = self._plain(*plain.groups()) if plain else self._library(before + part)
        return b"".join([known[p] for p in parts])

    def _library(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _plain(self, word: str, marks: str) -> bytes:
        stem = self.stems.get(word)
        if stem is None:
            if len(self.stems) > REMEMBERED // 3:
                self.stems.clear()
            letters = word if word.isascii() else "".join([self.letters[b] for b in word.encode()])
            stem = self.stems[word] = array("I", [t.id for t in self.model.tokenize(self.letters[32] + letters)]).tobytes()
        after = self.marks.get(marks)
        if after is None:
            if len(self.marks) > 10_000:
                self.marks = {"": b""}
            after = self.marks[marks] = self._library(marks)
        return stem + after if marks else stem


def _worker_words(path: str) -> WordIds:
    """One table for all tasks that a Python worker runs."""
    return worker_keeps(("words", path), lambda: WordIds(path))


def _vocabulary_bits(path: str) -> int:
    from tokenizers import Tokenizer

    return max(1, (Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) - 1).bit_length())


def write(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> None:
    """Write the ids of all texts, each with end_id after it, to folder, ascending by id.

    A null text is empty and has end_id alone; a very long one makes its shard as long as it
    needs. Null ids come first; rows of one id follow each other by their texts' hash and
    text, repeated rows stay. An empty table writes no shard; other columns are ignored,
    whatever their names. A row of folder is a shard: (part, seq, start, n_tokens, doc_ids,
    lengths, payload), start counting from the part's first id; each is a file of its own.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    bits = _vocabulary_bits(tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, end = _worker_words(tokenizer_path), np.array([end_id], "<u4").tobytes()
        part, seq, start, held, ids, size = TaskContext.get().partitionId(), 0, 0, [], [], 0

        def shard() -> pa.RecordBatch:
            payload = packed(np.frombuffer(b"".join(held), "<u4"), bits)
            lengths = [len(x) // 4 for x in held]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            plain = [pa.array([x], kind) for x, kind in zip((part, seq, start, size), kinds, strict=True)]
            lists = [pa.ListArray.from_arrays([0, len(ids)], pa.concat_arrays(ids)), pa.array([lengths], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays([*plain, *lists, pa.array([payload], pa.binary())], names=["part", "seq", "start", "n_tokens", "doc_ids", "lengths", "payload"])

        for batch in batches:
            for row in range(batch.num_rows):
                held.append(words.ids(batch.column(1)[row].as_py()) + end)
                ids.append(batch.column(0).slice(row, 1))
                size += len(held[-1]) // 4
                if size >= shard_tokens:
                    yield shard()
                    seq, start, held, ids, size = seq + 1, start + size, [], [], 0
        if held:
            yield shard()

    laid = rows.repartitionByRange(F.col("id").asc_nulls_first(), "h").sortWithinPartitions(F.col("id").asc_nulls_first(), "h", "text").select("id", "text")
    schema = f"part int, seq int, start long, n_tokens long, doc_ids array<{id_type}>, lengths array<long>, payload binary"
    laid.mapInArrow(run, schema).write.option("maxRecordsPerFile", 1).option("compression", "none").parquet(folder)


def shards(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of folder, with start counted from the first id of all.

    What stands before a part is added up over the parts' sums, a row for each.
    """
    rows = spark.read.parquet(folder)
    sums = rows.groupBy("part").agg(F.sum("n_tokens").alias("own"))
    before = sums.select("part", (F.sum("own").over(Window.orderBy("part")) - F.col("own")).alias("before"))
    return rows.join(F.broadcast(before), "part").withColumn("start", F.col("start") + F.col("before")).drop("before")


def read(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids) of each document, from the planes; start counts the ids of all documents before it.

    ids are little-endian unsigned 32-bit integers, the end mark with them.
    """
    rows = shards(spark, folder).select("start", "doc_ids", "lengths", "payload")
    id_type = rows.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                start, lengths = batch.column(0)[row].as_py(), np.array(batch.column(2)[row].as_py(), np.int64)
                raw, ends = Wavelet(batch.column(3)[row].as_py()).ids().astype("<u4").tobytes(), np.cumsum(lengths)
                ids = [raw[4 * (b - n) : 4 * b] for b, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(1)[row].values, pa.array(start + ends - lengths), pa.array(lengths), pa.array(ids, pa.binary())], names=[id_col, "start", "n_tokens", "ids"])

    return rows.mapInArrow(run, f"`{id_col}` {id_type}, start long, n_tokens long, ids binary")


def count_tokens(spark: SparkSession, folder: str, tokens: list[int]) -> DataFrame:
    """(token, n) over all shards for each of a stated list of ids, by rank; 0 where one doesn't occur."""
    wanted = sorted(set(tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for payload in batch.column(0):
                w = Wavelet(payload.as_py())
                total += [w.count(t) for t in wanted]
        yield pa.RecordBatch.from_arrays([pa.array(wanted, pa.int64()), pa.array(total)], names=["token", "n"])

    found = spark.read.parquet(folder).select("payload").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    asked = spark.createDataFrame([(t,) for t in wanted], "token long")
    return asked.join(found, "token", "left").select("token", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def occurrences(spark: SparkSession, folder: str, tokens: list[int], id_col: str = "doc_id") -> DataFrame:
    """(token, id, at, place): every occurrence of a stated list of ids, by select; at counts in the document, place over all."""
    wanted = sorted(set(tokens))
    rows = shards(spark, folder).select("start", "doc_ids", "lengths", "payload")
    id_type = rows.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                w, start = Wavelet(batch.column(3)[row].as_py()), batch.column(0)[row].as_py()
                ends = np.cumsum(np.array(batch.column(2)[row].as_py(), np.int64))
                for token in wanted:
                    places = w.places(token)
                    of = np.searchsorted(ends, places, "right")
                    firsts = np.concatenate([[0], ends])[of]
                    arrays = [pa.array(np.full(len(places), token)), batch.column(1)[row].values.take(pa.array(of)), pa.array(places - firsts), pa.array(places + start)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["token", id_col, "at", "place"])

    return rows.mapInArrow(run, f"token long, `{id_col}` {id_type}, at long, place long")


def tokens_at(places: DataFrame, folder: str, place_col: str = "place", out: str = "token", cell: int = SHARD_TOKENS) -> DataFrame:
    """(place, token) of the distinct places counted over all ids, by access; null places and those outside are left out.

    Places meet the shards' spans in cells of a grid; a shard's places are at most its ids.
    """
    out = free_name(out, [place_col])
    where = shards(places.sparkSession, folder).select("part", "seq", F.col("start").alias("s"), (F.col("start") + F.col("n_tokens")).alias("e"))
    where = where.withColumn("cell", F.explode(F.sequence(F.expr(f"s div {cell}"), F.expr(f"(e - 1) div {cell}"))))
    asked = places.select(F.col(place_col).cast("long").alias("place")).where("place >= 0").distinct().withColumn("cell", F.expr(f"place div {cell}"))
    found = asked.join(where, "cell").where("place >= s and place < e").groupBy("part", "seq").agg(F.collect_list(F.struct("place", "s")).alias("asked"))
    rows = found.join(places.sparkSession.read.parquet(folder).select("part", "seq", "payload"), ["part", "seq"]).select("asked.place", F.col("asked").getItem(0)["s"].alias("s"), "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                at = np.array(batch.column(0)[row].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(Wavelet(batch.column(2)[row].as_py()).at(at - batch.column(1)[row].as_py()))], names=[place_col, out])

    return rows.mapInArrow(run, f"`{place_col}` long, `{out}` long")
