"""Structured Streaming: incremental windows, late data, sessions and keyed state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from loomcast.operators.windows import top_per_group


def read_files(spark: SparkSession, path: str, schema, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def tumbling_counts(stream: DataFrame, at: str, key: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, key, n, total) by tumbling window; rows later than `late` are dropped."""
    w = F.window(at, width)
    out = stream.withWatermark(at, late).groupBy(w, key).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("start"), key, "n", "total")


def sliding_counts(stream: DataFrame, at: str, key: str, width: str, slide: str, late: str) -> DataFrame:
    out = stream.withWatermark(at, late).groupBy(F.window(at, width, slide), key).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("window.start").alias("start"), key, "n")


def sessions(stream: DataFrame, at: str, key: str, gap: str, late: str) -> DataFrame:
    out = stream.withWatermark(at, late).groupBy(F.session_window(at, gap), key).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), key, "n")


def deduplicated(stream: DataFrame, at: str, keys: list[str], late: str) -> DataFrame:
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def joined(left: DataFrame, right: DataFrame, key: str, left_at: str, right_at: str, within: str, late: str) -> DataFrame:
    """Inner join of two streams on key with right at most `within` after left."""
    a, b = left.withWatermark(left_at, late).alias("a"), right.withWatermark(right_at, late).alias("b")
    span = F.col(f"b.{right_at}").between(F.col(f"a.{left_at}"), F.col(f"a.{left_at}") + F.expr(f"INTERVAL {within}"))
    return a.join(b, (F.col(f"a.{key}") == F.col(f"b.{key}")) & span)


def window_table_sink(path: str, key: str, at: str, days: int, as_of: Callable[[], str]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that keeps a rolling window table: new rows in, aged rows out, each state in a folder of its own.

    State n is the table after batch n: readers take the largest. A batch that is run again
    writes the same state again, so the sink is idempotent; rows of one key and time are
    ordered by their columns. The table is a window's worth of rows, written whole.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark, rest = batch.sparkSession, [F.to_json(F.struct(*batch.columns))]
        start = F.lit(as_of()).cast("timestamp") - F.expr(f"INTERVAL {days} DAYS")
        fresh = top_per_group(batch.where(F.col(at) >= start), [key], [F.col(at).desc(), *rest])
        if number:
            old = spark.read.parquet(f"{path}/state={number - 1}").where(F.col(at) >= start)
            fresh = old.join(fresh, key, "left_anti").unionByName(fresh)
        fresh.write.mode("overwrite").parquet(f"{path}/state={number}")

    return write


#: State of a key and what is told about it.
FAILURES = "failures int, paused_until double"


def failure_tracker(stream: DataFrame, key: str, at: str, failed: str, most: int = 3, pause_s: float = 600.0) -> DataFrame:
    """(key, failures, paused_until): `most` failures in a row pause a key for pause_s from the last; a success clears it."""

    def run(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        count, until = state.get if state.exists else (0, 0.0)
        for t, bad in sorted((float(t), bool(b)) for f in frames for t, b in zip(f["__t"], f["__f"], strict=True)):
            count = count + 1 if bad else 0
            if count >= most:
                until, count = t + pause_s, 0
        state.update((count, until))
        yield pd.DataFrame({key: [k[0]], "failures": [count], "paused_until": [until]})

    kind = stream.schema[key].dataType.simpleString()
    rows = stream.select(key, (F.unix_micros(at) / 1e6).alias("__t"), F.col(failed).alias("__f"))
    return rows.groupBy(key).applyInPandasWithState(run, f"`{key}` {kind}, {FAILURES}", FAILURES, "update", GroupStateTimeout.NoTimeout)


def rate_limiter(stream: DataFrame, key: str, at: str, limit: int, window_s: float = 3600.0) -> DataFrame:
    """(key, at_s, allowed): at most limit requests a window, which restarts at the first request window_s or more after its start."""

    def run(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        start, used = state.get if state.exists else (-1e18, 0)
        rows = []
        for t in sorted(float(t) for f in frames for t in f["__t"]):
            if t >= start + window_s:
                start, used = t, 0
            used += 1
            rows.append((k[0], t, used <= limit))
        state.update((start, used))
        yield pd.DataFrame(rows, columns=[key, "at_s", "allowed"])

    kind = stream.schema[key].dataType.simpleString()
    rows = stream.select(key, (F.unix_micros(at) / 1e6).alias("__t"))
    return rows.groupBy(key).applyInPandasWithState(run, f"`{key}` {kind}, at_s double, allowed boolean", "start double, used int", "append", GroupStateTimeout.NoTimeout)


def speaker_turns(stream: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """(key, value, start_s, end_s): runs of one value; a run is told when the next begins."""

    def run(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now, start, end = state.get if state.exists else (None, 0.0, 0.0)
        rows = []
        for t, v in sorted(((float(t), v) for f in frames for t, v in zip(f["__t"], f["__v"], strict=True)), key=lambda x: x[0]):
            if v != now:
                if now is not None:
                    rows.append((k[0], now, start, end))
                now, start = v, t
            end = t
        state.update((now, start, end))
        yield pd.DataFrame(rows, columns=[key, value, "start_s", "end_s"])

    kind = stream.schema[key].dataType.simpleString()
    rows = stream.select(key, (F.unix_micros(at) / 1e6).alias("__t"), F.col(value).cast("string").alias("__v"))
    return rows.groupBy(key).applyInPandasWithState(run, f"`{key}` {kind}, `{value}` string, start_s double, end_s double", "now string, start double, end double", "append", GroupStateTimeout.NoTimeout)


def stale(tasks: DataFrame, heartbeat: str, as_of: str, limits: dict[str, int], default: int, kind: str = "event_type") -> DataFrame:
    """Tasks whose last heartbeat is older than their type's limit in seconds."""
    pairs = F.create_map(*[x for k, v in limits.items() for x in (F.lit(k), F.lit(v))])
    limit = F.coalesce(F.try_element_at(pairs, F.col(kind)), F.lit(default))
    return tasks.where(F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(heartbeat) > limit)


def run_once(stream: DataFrame, name: str, mode: str, checkpoint: str) -> DataFrame:
    """Runs a stream over all that is there into a memory table of that name (tests, backfills)."""
    spark = stream.sparkSession
    q = stream.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


def run_updates(stream: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Runs a stream in update mode over all that is there; the newest row of each of keys.

    Each batch's updates go to a folder of its own under path, a shared one, so that a
    batch that is run again writes the same rows again; the stream's checkpoint lies beside them.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/rows/batch={number}")

    write(spark.createDataFrame([], stream.schema), -1)
    q = stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return top_per_group(spark.read.parquet(f"{path}/rows"), keys, [F.col("batch").desc()]).drop("batch")
