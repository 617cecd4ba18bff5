"""Aggregates kept up under inserts, updates and deletes: a feed of signed rows moves a state from batch to batch.

An insert is a row of sign 1, a delete the old row with sign -1, an update both. The state
holds, for each key, its (unit, time) rows with counts and sums, which is what it takes to
take back a count, a sum, a distinct unit or the latest one; rows that come to nothing go.
Keys are dealt into buckets: a batch reads and writes those of its own rows only, each as
a new version, and a manifest of one row a bucket names the versions that make a state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 32
#: Parts of a bucket that are written apart.
SHARES = 4


def at_state(spark: SparkSession, path: str, table: str, number: int) -> DataFrame:
    """A table (`rows` or `totals`) as batch `number` left it."""
    named = spark.read.parquet(f"{path}/manifest/state={number}")
    return spark.read.parquet(f"{path}/{table}").join(F.broadcast(named), ["bucket", "version"]).drop("version")


def maintained_sink(path: str, key: str, unit: str, at: str, value: str, sign: str = "sign", buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function over signed rows that keeps `totals`: (key, n, total, units, last_unit, last_at).

    n counts rows, total sums value (a decimal), units counts distinct units, last_unit is
    that of the latest row, the greatest of equal times. Batches may come in any grouping,
    a delete before its insert too: the last state is the same. A batch that is run again
    writes the same versions again.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        by = [key, unit, at]
        signed = batch.select(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket"), *by, F.col(sign).cast("long").alias("n"), (F.col(value) * F.col(sign)).alias("total"))
        kind = signed.agg(F.sum("total").alias("total")).schema["total"].dataType
        rows = signed.withColumn("total", F.col("total").cast(kind))
        touched = [r.bucket for r in rows.select("bucket").distinct().collect()]  # at most `buckets`
        if number:
            old = at_state(spark, path, "rows", number - 1).where(F.col("bucket").isin(touched))
            rows = rows.unionByName(old.select(rows.columns))
        # Old and new rows meet in one shuffle and are written from it. A bucket is dealt by unit too, so that a key with most of the rows is written by several tasks.
        rows = rows.withColumn("share", F.pmod(F.xxhash64(unit), F.lit(SHARES)).cast("int")).repartition("bucket", "share")
        rows = rows.groupBy("bucket", "share", *by).agg(F.sum("n").alias("n"), F.sum("total").cast(kind).alias("total")).drop("share")
        rows = rows.where("n <> 0").withColumn("version", F.lit(number))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "version").parquet(f"{path}/rows")
        empty = spark.createDataFrame([(b, number) for b in touched], "bucket int, version int")
        if number:
            before = spark.read.parquet(f"{path}/manifest/state={number - 1}")
            empty = before.join(F.broadcast(empty), "bucket", "left_anti").unionByName(empty)
        empty.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/state={number}")  # one row a bucket
        now = spark.read.schema(rows.schema).parquet(f"{path}/rows").where(F.col("bucket").isin(touched) & (F.col("version") == number))
        units = now.groupBy("bucket", key, unit).agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max(F.when(F.col("n") > 0, F.col(at))).alias("t"))
        last = F.max(F.when(F.col("n") > 0, F.struct(F.col("t").alias("t"), F.col(unit).alias("u")))).alias("last")
        totals = units.groupBy("bucket", key).agg(F.sum("n").alias("n"), F.sum("total").cast(kind).alias("total"), F.count_if(F.col("n") > 0).alias("units"), last)
        totals = totals.select("bucket", key, "n", "total", "units", F.col("last.u").alias("last_unit"), F.col("last.t").alias("last_at"), F.lit(number).alias("version"))
        totals.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "version").parquet(f"{path}/totals")

    return write


def run_maintained(stream: DataFrame, path: str, key: str, unit: str, at: str, value: str, **how) -> DataFrame:
    """The totals after all that the stream of signed rows has; the stream's checkpoint lies under path."""
    q = stream.writeStream.foreachBatch(maintained_sink(path, key, unit, at, value, **how)).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    last = stream.sparkSession.read.parquet(f"{path}/manifest").agg(F.max("state")).first()[0]
    return at_state(stream.sparkSession, path, "totals", last).drop("bucket")
