"""Registry of queries: a name, a function of (spark, sf_dir) and, where SQL can say it, an oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: The domain's tables as the oracles see them, over the driver's tables.
PRELUDE = """WITH RECURSIVE content AS (
  SELECT o_orderkey AS content_id, o_custkey AS channel_id, o_orderdate AS publish_date, o_totalprice AS duration, o_orderpriority AS platform, o_orderstatus AS state FROM orders
), channels AS (
  SELECT c_custkey AS channel_id, c_name AS channel_name, c_mktsegment AS project, c_acctbal AS score, c_nationkey AS nation FROM customer
), segments AS (
  SELECT l_orderkey AS content_id, l_linenumber AS idx, ((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey) * 100000 + l_suppkey AS segment_id, l_extendedprice AS start_time, l_extendedprice + l_quantity AS end_time, l_quantity AS length,
         l_suppkey AS speaker_id, l_partkey AS theme_id, l_returnflag AS emotion, l_linestatus AS status, l_discount AS confidence, l_shipdate AS segment_date FROM lineitem
), ev AS (
  SELECT event_id, ts, user_id, event_type, value, props, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
), vec AS (SELECT vec_id, embedding::DOUBLE[] AS e, label FROM embeddings)
"""


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query; sql follows the domain's common table expressions, further ones start with a comma."""

    def add(f: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = f
        if sql is not None:
            ORACLES[key] = PRELUDE + sql.strip()
        return f

    return add


class Tables:
    """The domain's tables over a folder of the driver's tables; only the columns a query uses are read."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @property
    def content(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("content_id"), F.col("o_custkey").alias("channel_id"), F.col("o_orderdate").cast("timestamp").alias("publish_date"),
            F.col("o_totalprice").alias("duration"), F.col("o_orderpriority").alias("platform"), F.col("o_orderstatus").alias("state"),
        )

    @property
    def channels(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("channel_id"), F.col("c_name").alias("channel_name"), F.col("c_mktsegment").alias("project"), F.col("c_acctbal").alias("score"), F.col("c_nationkey").alias("nation"),
        )

    @property
    def segments(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("content_id"), F.col("l_linenumber").alias("idx"), (((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1000000 + F.col("l_partkey")) * 100000 + F.col("l_suppkey")).alias("segment_id"),
            F.col("l_extendedprice").alias("start_time"), (F.col("l_extendedprice") + F.col("l_quantity")).alias("end_time"), F.col("l_quantity").alias("length"),
            F.col("l_suppkey").alias("speaker_id"), F.col("l_partkey").alias("theme_id"), F.col("l_returnflag").alias("emotion"), F.col("l_linestatus").alias("status"),
            F.col("l_discount").alias("confidence"), F.col("l_shipdate").cast("timestamp").alias("segment_date"),
        )

    @property
    def events(self) -> DataFrame:
        return self.raw("events").select(
            "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value", "props",
            F.expr("try_cast(get_json_object(props, '$.k') as bigint)").alias("k"),
        )

    @property
    def vectors(self) -> DataFrame:
        return self.raw("embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"), "label")

    @property
    def documents(self) -> DataFrame:
        return self.raw("documents")

    @property
    def turns(self) -> DataFrame:
        return self.raw("conversations")
