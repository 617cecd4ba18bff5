"""Text functions that scan in order or need the standard library: Arrow-batched UDFs."""

from __future__ import annotations

import difflib
import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

_QUOTES = str.maketrans({"‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-", "…": "..."})
_REPEATED = re.compile(r"([^\x00-\x7f])\1{2,}")


def clean_artifacts_text(text: str | None) -> str | None:
    """NFKC, plain quotes and dashes, runs of a non-ASCII character cut to one, white space as one space."""
    if text is None:
        return None
    out = unicodedata.normalize("NFKC", text).translate(_QUOTES)
    return " ".join(_REPEATED.sub(r"\1", out).split())


def cap_ngram_runs_text(text: str | None, most_words: int = 6, repeats: int = 2) -> str | None:
    """Greedy from long n-grams to pairs: at most `repeats` copies of an n-gram in a row.

    For each n the words that equal the one n places on are counted backwards, which gives
    the length of every run in one pass.
    """
    if text is None:
        return None
    words = text.split()
    for n in range(min(most_words, len(words) // 2), 1, -1):
        alike = [0] * (len(words) + 1)  # how many places in a row equal the place n on
        for i in range(len(words) - n - 1, -1, -1):
            alike[i] = alike[i + 1] + 1 if words[i] == words[i + n] else 0
        out, i = [], 0
        while i < len(words):
            k = alike[i] // n + 1
            if k > repeats and i + n <= len(words):
                out += words[i : i + n] * repeats
                i += k * n
            else:
                out.append(words[i])
                i += 1
        words = out
    return " ".join(words)


def title_ratio(a: str | None, b: str | None, least: float = 0.0) -> float | None:
    """difflib's ratio of two titles, without regard to case; 0 where its cheap upper bounds are below least."""
    if a is None or b is None:
        return None
    match = difflib.SequenceMatcher(None, a.lower(), b.lower())
    return match.ratio() if match.real_quick_ratio() >= least and match.quick_ratio() >= least else 0.0


#: Texts that are Python strings at once, within a batch.
TEXTS_AT_ONCE = 64


def in_slices(texts: pa.Array, change: Callable[[str | None], str | None]) -> pa.Array:
    """change of each text; of a batch only some texts at a time are Python strings."""
    parts = [pa.array([change(t) for t in texts.slice(at, TEXTS_AT_ONCE).to_pylist()], pa.string()) for at in range(0, len(texts), TEXTS_AT_ONCE)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


@F.arrow_udf(T.StringType())
def clean_artifacts(texts: pa.Array) -> pa.Array:
    return in_slices(texts, clean_artifacts_text)


@F.arrow_udf(T.StringType())
def cap_ngram_runs(texts: pa.Array) -> pa.Array:
    return in_slices(texts, cap_ngram_runs_text)


def title_ratios(a: Sequence[str | None], b: Sequence[str | None], least: float = 0.0) -> list[float | None]:
    """title_ratio of each pair; what difflib works out for a second title serves all its pairs."""
    out: list[float | None] = [None] * len(a)
    whole = [i for i in range(len(a)) if a[i] is not None and b[i] is not None]
    match, now = difflib.SequenceMatcher(None), None
    for i in sorted(whole, key=lambda i: b[i]):
        if b[i] != now:
            now = b[i]
            match.set_seq2(now.lower())
        match.set_seq1(a[i].lower())
        out[i] = match.ratio() if match.real_quick_ratio() >= least and match.quick_ratio() >= least else 0.0
    return out


def title_similarity(a, b, least: float = 0.0):
    @F.pandas_udf(T.DoubleType())
    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(title_ratios(x.tolist(), y.tolist(), least), dtype=float)

    return ratio(a, b)


def hashed_vector_of(text: str | None, dim: int = 64) -> np.ndarray:
    """Each word adds 1 or -1 to a place that its hash names; unit length. No model, no claim of meaning."""
    v = np.zeros(dim)
    for w in re.findall(r"\w+", (text or "").lower()):
        h = zlib.crc32(w.encode())
        v[h % dim] += 1.0 if h >> 31 else -1.0
    return v / max(float(np.linalg.norm(v)), 1e-12)


def segment_ends(counts: Sequence[int], vecs: np.ndarray, target: int, limit: int, ahead: int = 3, coherence: float = 0.5) -> list[int]:
    """Where segments of sentences end (exclusive): at limit words, or from target on where the next sentences cohere no more.

    Coherence is the mean product of the segment's mean vector with the next `ahead` sentences' vectors.
    """
    ends, start, held = [], 0, 0
    for i, n in enumerate(counts):
        held += n
        cut = held >= limit
        if not cut and held >= target:
            following = vecs[i + 1 : i + 1 + ahead]
            cut = not len(following) or float((following @ vecs[start : i + 1].mean(axis=0)).mean()) < coherence
        if cut:
            ends.append(i + 1)
            start, held = i + 1, 0
    if start < len(counts):
        ends.append(len(counts))
    return ends


def coherent_segments(target: int = 250, limit: int = 350, ahead: int = 3, coherence: float = 0.5, embed: Callable[[str], np.ndarray] = hashed_vector_of):
    """A function for mapInPandas over (id, text) that yields (id, segment, text, words): whole sentences, cut by segment_ends."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for i, text in zip(frame["id"], frame["text"], strict=True):
                sentences = [s for s in re.split(r"(?<=[.!?])\s+", text or "") if s.strip()]
                counts = [len(s.split()) for s in sentences]
                vecs = np.array([embed(s) for s in sentences]) if sum(counts) >= target else np.zeros((len(counts), 1))
                at = 0
                for number, end in enumerate(segment_ends(counts, vecs, target, limit, ahead, coherence)):
                    rows.append((i, number, " ".join(" ".join(sentences[at:end]).split()), sum(counts[at:end])))
                    at = end
            yield pd.DataFrame(rows, columns=["id", "segment", "text", "words"])

    return run
