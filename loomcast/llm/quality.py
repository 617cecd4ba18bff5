"""Quality classifier: supervised subword embeddings, trained by numpy stochastic gradient descent.

A document's features are its words, the character n-grams of its words (with the space
before and after a word as its bounds) and two marks of repetition (a word like the one
before it; three words in a row that came before), hashed into BUCKETS rows of a learned
table. The rows are averaged over the whole text, together with PRIOR empty features so
that little text says little, and a softmax layer gives the labels' probabilities.
Training uses a bounded sample of labelled rows; scoring reads every text whole. Because
the layer after the average is linear, scoring folds table and layer into one number a
bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import free_name, worker_keeps

BUCKETS, DIM, GRAMS = 1 << 14, 16, (2, 3, 4)
#: At most so many labelled rows are fitted, the first in an order by a hash of their ids.
SAMPLE = 3000
EPOCHS, RATE, SEED, PRIOR, BATCH = 8, 0.5, 7, 64, 8
#: A row of the table gets a small share of each text; its steps are larger by this.
GAIN = 300.0
#: Characters hashed at once; what is kept of a whole text is four bytes a word.
AT_ONCE = 1 << 19
#: Buckets of the marks of repetition.
SAME, AGAIN = 0, 1

_POWERS = np.cumprod(np.full(1024, 0x01000193, np.uint32), dtype=np.uint32)


def _spread(h: np.ndarray) -> np.ndarray:
    """Bucket of each 32-bit hash."""
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return ((h ^ (h >> np.uint32(13))) & np.uint32(BUCKETS - 1)).astype(np.int64)


def _spaces(c: np.ndarray) -> np.ndarray:
    """Where ASCII white space stands."""
    return (c == 32) | (c - np.uint32(9) <= 4)


def _gram_hashes(c: np.ndarray, space: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams that hold part of one word: white space stands at their ends only, and not at all places."""
    size = max(0, len(c) - n + 1)
    h = np.full(size, 0x811C9DC5 + n, np.uint32)
    for i in range(n):
        h = (h ^ c[i : size + i]) * np.uint32(0x01000193)
    bad = space[:size] & space[n - 1 : n - 1 + size] if n == 2 else np.zeros(size, bool)
    for i in range(1, n - 1):
        bad |= space[i : size + i]
    return h[~bad]


def _word_hashes(c: np.ndarray, space: np.ndarray) -> np.ndarray:
    inside = np.flatnonzero(~space)
    if not len(inside):
        return np.empty(0, np.uint32)
    first = np.concatenate([[True], np.diff(inside) > 1])
    starts = np.flatnonzero(first)
    place = np.arange(len(inside)) - np.repeat(starts, np.diff(np.append(starts, len(inside))))
    mixed = (c[inside] + np.uint32(1)) * _POWERS[place & 1023]
    return np.add.reduceat(mixed, starts, dtype=np.uint32) ^ np.uint32(0x9E3779B9)


def bucket_counts(text: str) -> np.ndarray:
    """How often each bucket's feature occurs in the whole text.

    Hashing goes part by part, with parts that end between words; the marks of repetition
    are counted over the word hashes of the whole text. So the parts don't show.
    """
    counts = np.zeros(BUCKETS, np.int64)
    whole = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    at, words = 0, []
    while at < len(whole):
        to = min(len(whole), at + AT_ONCE)
        while to < len(whole) and not _spaces(whole[to - 1 : to])[0]:  # on to the end of the word
            gap = np.flatnonzero(_spaces(whole[to : to + AT_ONCE]))
            to = to + int(gap[0]) + 1 if len(gap) else min(len(whole), to + AT_ONCE)
        part = whole[max(0, at - 1) : to]  # the space before it belongs to its first word
        space = _spaces(part)
        for n in GRAMS:
            counts += np.bincount(_spread(_gram_hashes(part, space, n)), minlength=BUCKETS)
        words.append(_word_hashes(part, space))
        counts += np.bincount(_spread(words[-1]), minlength=BUCKETS)
        at = to
    if words:
        w = np.concatenate(words)
        counts[SAME] += int((w[1:] == w[:-1]).sum())
        if len(w) > 2:
            runs = (w[:-2] * np.uint32(31) ^ w[1:-1]) * np.uint32(0x85EBCA6B) ^ w[2:]
            counts[AGAIN] += len(runs) - len(np.unique(runs))
    return counts


class Model:
    """Embedding table and softmax layer; weights and bias are what scoring needs of them."""

    def __init__(self, weights: np.ndarray, bias: float) -> None:
        self.weights, self.bias = weights.astype(np.float64), float(bias)

    def score(self, counts: np.ndarray) -> float:
        logit = self.bias + float(counts @ self.weights) / (counts.sum() + PRIOR)
        return float(1 / (1 + np.exp(-np.clip(logit, -50, 50))))


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED, batch: int = BATCH) -> Model:
    """examples: (buckets, their share of the text, label 0 or 1); steps are taken on small batches. One label alone gives a constant model."""
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 1 / DIM, (BUCKETS, DIM))
    layer, bias = np.zeros((DIM, 2)), np.zeros(2)
    layer[:, 1], layer[:, 0] = rng.normal(0, 0.1, DIM), 0.0
    steps, step = max(1, epochs * len(examples)), 0
    for _ in range(epochs):
        order = rng.permutation(len(examples)).tolist()
        for at in range(0, len(order), batch):
            picked = [examples[i] for i in order[at : at + batch]]
            buckets, places = np.unique(np.concatenate([b for b, _, _ in picked]), return_inverse=True)
            rows = np.repeat(np.arange(len(picked)), [len(b) for b, _, _ in picked])
            share = np.zeros((len(picked), len(buckets)))
            share[rows, places] = np.concatenate([s for _, s, _ in picked])
            now = rate * (1 - step / steps)
            step += len(picked)
            mean = share @ table[buckets]
            logits = mean @ layer + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(picked)), [label for _, _, label in picked]] -= 1
            back = p @ layer.T
            layer -= now * (mean.T @ p)
            bias -= now * p.sum(axis=0)
            table[buckets] -= (now * GAIN) * (share.T @ back)
    return Model(table @ (layer[:, 1] - layer[:, 0]), bias[1] - bias[0])


def features(docs: DataFrame, label_col: str = "label", text_col: str = "text") -> DataFrame:
    """(buckets, shares, label) of labelled texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_keeps()
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = bucket_counts(text or "")
                at = np.flatnonzero(counts)
                share = (counts[at] / (counts.sum() + PRIOR)).astype("<f4")
                yield pa.RecordBatch.from_arrays([pa.array([at.astype("<u2").tobytes()]), pa.array([share.tobytes()]), pa.array([label], pa.int32())], names=["buckets", "shares", "label"])

    return docs.select(text_col, F.col(label_col).cast("int").alias("label")).mapInArrow(run, "buckets binary, shares binary, label int")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """Fits on at most `sample` labelled rows; labels: (id, label 0 or 1), null labels and ids ignored.

    Labels of one id that disagree are ignored. What is broadcast and brought to the
    driver is bounded by sample: ids, and at most BUCKETS features of each row. Without
    labelled rows every score is 0.5.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min(label_col).alias("label"), F.max(label_col).alias("most")).where("label = most")
    picked = known.orderBy(F.xxhash64(id_col), id_col).limit(sample).select(F.col(id_col).alias("__id"), "label")
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(picked), "__id")
    examples = []
    for r in sorted(features(rows, "label", "__text").collect(), key=lambda r: (bytes(r.buckets), bytes(r.shares), r.label)):
        examples.append((np.frombuffer(r.buckets, "<u2").astype(np.int64), np.frombuffer(r.shares, "<f4").astype(np.float64), r.label))
    return train(examples) if examples else Model(np.zeros(BUCKETS), 0.0)


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """docs with score_col: the probability of label 1, from the whole text alone.

    A null text is empty; an empty one has a score too. Very long texts are hashed part by
    part, with the result of hashing them at once. Repeated rows score alike; an empty
    table gives an empty result; a column of docs named score_col is replaced.
    """
    docs = docs.drop(score_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    at, weights, bias = docs.columns.index(text_col), model.weights, model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_keeps()
        fitted = Model(weights, bias)
        for batch in batches:
            scores = [fitted.score(bucket_counts(t or "")) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, score_col])

    return docs.mapInArrow(run, f"{schema}, `{score_col}` double")


def held_out(id_col: str = "doc_id") -> F.Column:
    """Rows whose labels are never learnt."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def accepted(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of docs whose score reaches threshold, with their columns, whatever their names."""
    name = free_name("score", docs.columns)
    return score(docs, model, text_col, name).where(F.col(name) >= threshold).drop(name)
