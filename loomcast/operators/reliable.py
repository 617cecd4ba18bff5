"""Reliable checkpoints, and the iterative algorithm that most needs them: connected components."""

from __future__ import annotations

import tempfile
import uuid
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder that the cluster names in spark.checkpoint.dir.

    Where none is named, a temporary folder serves local sessions (tests); elsewhere
    that would lose data with its machine, so it is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="loomcast-checkpoint-")
    sc.setCheckpointDir(named)


def shared_folder(spark: SparkSession, name: str) -> str:
    """The place of a new folder that all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and go on from what was written."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Rows that a task takes in where `dealt` deals them.
ROWS_A_TASK = 500_000


def dealt(df: DataFrame, n_rows: int, *by: str) -> DataFrame:
    """df dealt by hash to tasks of about ROWS_A_TASK of its n_rows rows, so that what a task holds doesn't grow with the table.

    What follows groups or joins by these columns without another shuffle, and nothing is
    combined before it: where most rows have a key of their own, that takes memory and
    saves nothing.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-n_rows // ROWS_A_TASK)), *by)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the file system that Spark writes to."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def row_numbers(rows: DataFrame, out: str, start: int = 0) -> tuple[DataFrame, int]:
    """rows, a checkpoint, with out: numbers from start without gaps, in the order of its partitions; and the next number.

    One count for each partition goes through the driver.
    """
    sizes = dict(rows.groupBy(F.spark_partition_id().alias("part")).count().collect())
    firsts = list(accumulate((sizes.get(i, 0) for i in range(max(sizes, default=0))), initial=start))
    at = F.monotonically_increasing_id()  # the partition, and 33 bits for the place in it
    first = F.get(F.array(*[F.lit(x).cast("long") for x in firsts]), F.shiftright(at, 33).cast("int"))
    return rows.withColumn(out, first + at.bitwiseAND(F.lit((1 << 33) - 1))), start + sum(sizes.values())


def ranked_rows(rows: DataFrame, order: list, out: str) -> DataFrame:
    """rows with out: their rank from 0 in a total order, by range partitions; from a checkpoint."""
    return cut(row_numbers(cut(rows.repartitionByRange(*order).sortWithinPartitions(*order)), out)[0])


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of an edge list (a, b) of one orderable type.

    Alternates the large-star and small-star steps: every node points at the least
    neighbour it knows, so that chains halve each round. Every step is an aggregation
    with map-side combining and one equi-join, which AQE splits where a hub is hot;
    rounds are cut by a reliable checkpoint. Edges with a null end and loops are
    ignored. Returns (node, component) for nodes with an edge; component is the least
    node reachable.
    """

    def star(pairs: DataFrame) -> DataFrame:
        """Large star, then small star, over (a, b) with a > b."""
        both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = (
            both.join(least, both.a == least.u).where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        joined = large.join(low, large.a == low.u)
        return (
            joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
            .unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()
        )

    def mark(pairs: DataFrame):
        row = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        return tuple(row)

    now = cut(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = mark(now)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        now = cut(star(now))
        after = mark(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.unionByName(roots)
