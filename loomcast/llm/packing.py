"""Bound-certified best-fit packing of tokenised documents into fixed-length sequences.

Tokenising. The tokeniser lowers case, composes characters and never lets a token
cross white space, so a text's ids are those of its space-separated chunks in order.
Each Python worker keeps the ids of chunks met (a bounded table) and asks the tokeniser
library for the words of new ones only. Texts with characters that Python and the tokeniser take
differently (U+001C to U+001F) go to the library whole.

Packing. Pieces are dealt into bounded partitions and packed by best-fit decreasing. In
each, dual-feasible functions bound the number of bins from below. A partition that
meets its bound is certified; its closed bins stay. Partitions with a gap give up the
documents of their open bins and certified ones the emptiest quarter of theirs; these are dealt out
anew into fewer partitions and packed again, and the new packing is taken if it has
fewer bins, until the bins meet the bound of the whole table, a round gains nothing or
MAX_ROUNDS are done; then the last packing stands, whole and valid, with its gap to the
bound.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import cut, free_name, worker_keeps

CAPACITY, PARTITION_PIECES, MAX_ROUNDS = 2048, 20_000, 4
#: Of a certified partition's bins, one in so many is exchanged, the emptiest first.
EMPTIEST = 4
#: Chunks a worker remembers; beyond it the table starts anew.
REMEMBERED = 600_000
_ODD = ("\x1c", "\x1d", "\x1e", "\x1f")


#: Letters and numbers below U+0130, where composition changes nothing and lower case is plain.
_LETTERS, _NUMBERS, _PLAIN_END = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff\u0100-\u012f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\u0130"
_PLAIN_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_LETTERS}{_NUMBERS}]+")


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in table:
            table[b] = chr(extra)
            extra += 1
    return table


class ChunkTokenizer:
    """Ids of whole texts, as little-endian unsigned 32-bit bytes, equal to the library's.

    A new chunk below U+0130 is split into words here and its words, remembered too,
    go to the library's model; any other goes to the library as it is.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.specials = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.letters = byte_letters()

    def _library(self, text: str) -> bytes:
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        letters = word if word.isascii() else "".join([self.letters[b] for b in word.encode()])
        ids = self.words[word] = array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
        return ids

    def _chunk(self, chunk: str) -> bytes:
        if not chunk.isascii() and max(chunk) >= _PLAIN_END or not chunk.isprintable():
            return self._library(chunk)
        words, known = _PLAIN_WORDS.findall(chunk.lower()), self.words
        return b"".join([known[w] if w in known else self._word(w) for w in words])

    def ids(self, text: str) -> bytes:
        if any(c in text for c in _ODD) or any(s in text for s in self.specials):
            return self._library(text)
        chunks, known = text.split(), self.chunks
        try:
            return b"".join([known[c] for c in chunks])
        except KeyError:
            new = [c for c in dict.fromkeys(chunks) if c not in known]
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = list(dict.fromkeys(chunks))
        if len(self.words) > REMEMBERED:
            self.words.clear()
        for c in new:
            known[c] = self._chunk(c)
        return b"".join([known[c] for c in chunks])


def worker_tokenizer(path: str) -> ChunkTokenizer:
    """One table for all tasks that a Python worker runs."""
    return worker_keeps(("chunks", path), lambda: ChunkTokenizer(path))


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): each whole text's ids, then end_id, cut at capacity.

    A null text is empty and gives one piece of end_id alone; a very long one gives as many
    pieces as it takes. ids are little-endian unsigned 32-bit integers. Repeated rows give
    repeated pieces, null ids stay null, an empty table gives no pieces; other columns are
    ignored, whatever their names.
    """
    fields = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, end, step = worker_tokenizer(tokenizer_path), np.array([end_id], "<u4").tobytes(), 4 * capacity
        for batch in batches:
            rows: list[tuple] = []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = tok.ids(text or "") + end
                for p, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    rows.append((i, p, at // 4, len(part) // 4, zlib.crc32(part), part))
            which, *rest = zip(*rows, strict=True) if rows else [[]] * 6
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: 4 + with_ids]
            arrays = [pa.array(r, t) for r, t in zip(rest, types, strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(which, pa.int64())), *arrays], names=[id_col, "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids])

    return docs.select(id_col, text_col).mapInArrow(run, fields)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing of pieces needs; see bound_of_counts."""
    return bound_of_counts(np.bincount(lengths, minlength=capacity + 1)[: capacity + 1], capacity)


def bound_of_counts(count: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs of count[x] pieces of each length x: the best of two families of dual-feasible functions.

    f_t takes pieces over capacity - t as whole bins and leaves out those under t; u_k
    rounds a piece of x to floor((k + 1) x / capacity) / k bins, and leaves it where
    (k + 1) x / capacity is whole.
    """
    count = count.astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    n, total = np.cumsum(count), np.cumsum(count * size)
    t = np.arange(0, capacity // 2 + 1)
    below = np.where(t > 0, total[np.maximum(t - 1, 0)], 0)
    f = (n[-1] - n[capacity - t]) * capacity + total[capacity - t] - below
    best = int(-(-f.max() // capacity))
    for k in range(1, 33):
        scaled = (k + 1) * size
        doubled = np.where(scaled % capacity == 0, size * k, (scaled // capacity) * capacity)  # times k
        best = max(best, int(-(-int((count * doubled).sum()) // (capacity * k))))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(bin, offset) of each piece and the fill of each bin; ties by position."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, fill = 0, []
    for i, x in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fitting = open_rooms >> x
        if fitting:
            r = x + (fitting & -fitting).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                open_rooms ^= 1 << r
        else:
            b, r = len(fill), capacity
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += x
        if r > x:
            room[r - x].append(b)
            open_rooms |= 1 << (r - x)
    return bins, offsets, fill


def _pack_partitions(rows: DataFrame, capacity: int, parts: int, turn: int, names: dict[str, str]) -> DataFrame:
    """Deals rows into `parts` by their number and packs each; adds the columns bin, place and open as named."""
    row, part, bin_, place, open_ = (names[k] for k in ("row", "part", "bin", "place", "open"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + f", `{part}` long, `{bin_}` long, `{place}` long, `{open_}` boolean"

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", row], ascending=[False, True], kind="stable", ignore_index=True)
        lengths = pdf["length"].to_numpy(np.int64)
        bins, offsets, fill = best_fit_decreasing(lengths, capacity)
        filled = np.array(fill)
        loose = filled < capacity
        if len(fill) <= lower_bound(lengths, capacity):  # certified: only its emptiest bins may still gain elsewhere
            rank = np.empty(len(fill), np.int64)
            rank[np.argsort(filled, kind="stable")] = np.arange(len(fill))
            loose &= rank < max(1, len(fill) // EMPTIEST)
        return pdf.assign(**{bin_: (turn << 56) + (pdf[part].to_numpy(np.int64) << 24) + bins, place: offsets, open_: loose[bins]})

    dealt = rows.withColumn(part, F.pmod(F.xxhash64(row, F.lit(turn)), F.lit(parts)).cast("long"))
    return dealt.groupBy(part).applyInPandas(pack, schema).drop(part)


def pack(items: DataFrame, capacity: int = CAPACITY, partition_pieces: int = PARTITION_PIECES) -> DataFrame:
    """items with a column length, 1 to capacity, gain sequence_id and offset; all other columns are kept.

    A histogram of at most capacity lengths bounds the bins of the whole table; packing ends
    where it is met. Rows are numbered and dealt by number, so that repeated or null ids make no partition
    larger. Partitions hold about partition_pieces pieces at any size of the input; only
    counts reach the driver. Columns of items named sequence_id or offset are replaced.
    Pieces of equal length may be packed in any order. An empty table stays empty.
    """
    items = items.drop("sequence_id", "offset")
    names = {k: free_name(k, items.columns) for k in ("row", "part", "bin", "place", "open")}
    items = cut(items.withColumn(names["row"], F.monotonically_increasing_id()))

    def bins(df: DataFrame) -> int:
        return df.where(F.col(names["place"]) == 0).count()

    sizes = dict(items.groupBy("length").count().collect())
    n, histogram = sum(sizes.values()), np.zeros(capacity + 1, np.int64)
    histogram[list(sizes)] = list(sizes.values())
    least = bound_of_counts(histogram, capacity)
    packed = cut(_pack_partitions(items, capacity, max(1, -(-n // partition_pieces)), 0, names))
    done: DataFrame | None = None
    total = bins(packed)
    for turn in range(1, MAX_ROUNDS + 1):
        if total <= least:
            break
        loose = packed.where(F.col(names["open"]))
        left = loose.count()
        had = bins(loose)
        if had < 2:
            break
        again = cut(_pack_partitions(loose.select(items.columns), capacity, max(1, -(-left // partition_pieces)), turn, names))
        has = bins(again)
        if has >= had:
            break
        total -= had - has
        closed = packed.where(~F.col(names["open"]))
        done = closed if done is None else done.unionByName(closed)
        packed = again
    whole = packed if done is None else done.unionByName(packed)
    return whole.withColumns({"sequence_id": F.col(names["bin"]), "offset": F.col(names["place"])}).drop(*names.values())
