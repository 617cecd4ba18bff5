"""Keyed state with event-time timers: failures that pause a key until a cool-down ends, and heartbeats that stop."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PAUSES = "event string, at_ms long, until_ms long"


def _sorted(rows: Iterator[pd.DataFrame]) -> list[tuple]:
    """(ms, order, kind) of a key's rows of one batch, in time."""
    return sorted((int(t), o, k) for f in rows for t, o, k in zip(f["ms"], f["ord"], f["kind"], strict=True))


class FailurePauses(StatefulProcessor):
    """`most` failures, each within reset_ms of the one before and without a success between, pause a key.

    The pause lasts as the last failure's kind says. It ends with the next success or when
    its time is over, by the next row or, if none comes, by a timer; then counting starts anew.
    """

    def __init__(self, most: int, reset_ms: int, pauses_ms: Mapping[str, int]) -> None:
        self.most, self.reset, self.pauses = most, reset_ms, dict(pauses_ms)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("failures", "n int, last long, until long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        n, last, until = self.state.get() if self.state.exists() else (0, 0, 0)
        before, out = until, []
        for ms, _, kind in _sorted(rows):
            if until and ms >= until:
                out.append(("resumed", until, until))
                n, until = 0, 0
            if kind == "":
                if until:
                    out.append(("resumed", ms, until))
                n, until = 0, 0
                continue
            n = 1 if n and ms - last > self.reset else n + 1
            last = ms
            if n >= self.most:
                until = ms + self.pauses[kind]
                out.append(("paused", ms, until))
        if before and before != until:
            self.handle.deleteTimer(before)
        if until and before != until:
            self.handle.registerTimer(until)
        if n or until:
            self.state.update((n, last, until))
        else:
            self.state.clear()
        yield pd.DataFrame([(*key, *o) for o in out], columns=["key", "event", "at_ms", "until_ms"])

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        until = self.state.get()[2] if self.state.exists() else 0
        out = []
        if until and until <= expiredTimerInfo.getExpiryTimeInMs():
            out.append((*key, "resumed", until, until))
            self.state.clear()
        yield pd.DataFrame(out, columns=["key", "event", "at_ms", "until_ms"])

    def close(self) -> None:
        pass


class Heartbeats(StatefulProcessor):
    """Tells when a key's last row is limit_ms old: at the next row, or by a timer once the watermark has come so far."""

    def __init__(self, limits_ms: Mapping[str, int]) -> None:
        self.limits = dict(limits_ms)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("due", "due long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        before = due = self.state.get()[0] if self.state.exists() else 0
        out = []
        for ms, _, kind in _sorted(rows):
            if due and ms >= due:
                out.append(("stale", due, ms))
            due = max(due, ms + self.limits.get(kind, self.limits[""]))
        if before and before != due:
            self.handle.deleteTimer(before)
        if before != due:
            self.handle.registerTimer(due)
        self.state.update((due,))
        yield pd.DataFrame([(*key, *o) for o in out], columns=["key", "event", "at_ms", "until_ms"])

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        out = []
        if self.state.exists() and self.state.get()[0] <= expiredTimerInfo.getExpiryTimeInMs():
            out.append((*key, "stale", self.state.get()[0], None))
            self.state.clear()
        yield pd.DataFrame(out, columns=["key", "event", "at_ms", "until_ms"]).astype({"until_ms": "Int64"})

    def close(self) -> None:
        pass


def _timed(stream: DataFrame, processor: StatefulProcessor, key: str, at: str, order: str, kind, late: str) -> DataFrame:
    rows = stream.withWatermark(at, late).select(at, F.col(key).alias("key"), F.unix_millis(at).alias("ms"), F.col(order).alias("ord"), kind.alias("kind"))
    schema = f"key {rows.schema['key'].dataType.simpleString()}, {PAUSES}"
    return rows.groupBy("key").transformWithStateInPandas(processor, schema, "Append", "EventTime").withColumnRenamed("key", key)


def failure_pauses(stream: DataFrame, key: str, at: str, order: str, kind, most: int = 3, reset_s: int = 600, pauses_s: Mapping[str, int] | None = None, late: str = "1 hour") -> DataFrame:
    """(key, event, at_ms, until_ms) of pauses and their ends; kind is an expression: '' for a success, else a failure's kind.

    Rows of a key are taken in time within a batch, those of one time by order. State goes
    with its pause, or with a success.
    """
    pauses = {"error": 1800, "auth": 50400} if pauses_s is None else pauses_s
    return _timed(stream, FailurePauses(most, reset_s * 1000, {k: v * 1000 for k, v in pauses.items()}), key, at, order, kind, late)


def stale_heartbeats(stream: DataFrame, key: str, at: str, order: str, kind, limits_s: Mapping[str, int], late: str = "1 hour") -> DataFrame:
    """(key, event `stale`, at_ms, until_ms): when a key went stale, and when it was heard again (null: not yet); limits by kind, '' for others."""
    return _timed(stream, Heartbeats({k: v * 1000 for k, v in limits_s.items()}), key, at, order, kind, late)


def run_timed(stream: DataFrame, path: str) -> DataFrame:
    """All rows of a stream over what is there, each batch in a folder of its own under path, a shared one."""
    spark = stream.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, PROVIDER)  # timers need it; a query keeps what it started with

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/rows/batch={number}")

    try:
        write(spark.createDataFrame([], stream.schema), -1)
        q = stream.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        spark.conf.set(name, before)
    return spark.read.parquet(f"{path}/rows").drop("batch")
