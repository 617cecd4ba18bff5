"""Models in batches: loaded once a worker, called for so many texts at once, a bounded number of calls at a time."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Models that this worker has loaded, by name.
_LOADED: dict[str, Callable] = {}


def _model(name: str, load: Callable[[], Callable]) -> Callable:
    if name not in _LOADED:
        _LOADED[name] = load()
    return _LOADED[name]


def _patiently(model: Callable, texts: list, tries: int, wait_s: float) -> list:
    """The model's results, one a text; a failed call is made again, each time after twice the wait."""
    for k in range(tries):
        try:
            found = list(model(texts))
            break
        except Exception:
            if k + 1 == tries:
                raise
            time.sleep(wait_s * 2**k)
    if len(found) != len(texts):
        raise ValueError(f"the model gave {len(found)} results for {len(texts)} texts")
    return found


def called(series: Iterator[pd.Series], name: str, load: Callable[[], Callable], batch: int, at_once: int, tries: int, wait_s: float) -> Iterator[pd.Series]:
    """Each series' results: its distinct texts in batches, at_once of them in flight; null stays null."""
    with ThreadPoolExecutor(at_once) as pool:
        for texts in series:
            distinct = iter(pd.unique(texts.dropna()).tolist())
            batches = list(iter(lambda d=distinct: list(islice(d, batch)), []))
            model = _model(name, load) if batches else None
            found = pool.map(lambda b: _patiently(model, b, tries, wait_s), batches)  # noqa: B023
            known = {text: x for b, got in zip(batches, found, strict=True) for text, x in zip(b, got, strict=True)}
            yield pd.Series([known.get(t) if t is not None and t == t else None for t in texts], dtype=object)


def batched(name: str, load: Callable[[], Callable[[Sequence[str]], Sequence]], kind: str, batch: int = 64, at_once: int = 4, tries: int = 3, wait_s: float = 0.5) -> Callable[[Column], Column]:
    """A function of a text column that calls a model; load() gives one that takes a list of texts and returns one result each.

    A worker loads a model of that name once, whatever the tasks. Results are taken as
    costly: Spark works a column out once, wherever else it is named.
    """

    @F.pandas_udf(kind)
    def call(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return called(series, name, load, batch, at_once, tries, wait_s)

    return call.asNondeterministic()
