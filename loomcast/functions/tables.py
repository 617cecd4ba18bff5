"""Table functions: rows of a partitioned and ordered table, taken one partition after the other."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, udtf
from pyspark.sql.types import LongType, StructType


class LatestOf:
    """The first `most` rows of each partition, as they are ordered, with their rank; all columns of the table are kept.

    Usage: latest_of(TABLE(t) PARTITION BY key ORDER BY (time DESC, id), most). Nothing of a
    partition is held but a count.
    """

    def __init__(self) -> None:
        self.seen = 0

    @staticmethod
    def analyze(rows: AnalyzeArgument, most: AnalyzeArgument) -> AnalyzeResult:
        if not rows.isTable or not isinstance(most.value, int) or most.value < 1:
            raise ValueError("latest_of(TABLE(...) PARTITION BY ..., a number of rows)")
        return AnalyzeResult(StructType([*rows.dataType.fields]).add("rank", LongType()))

    def eval(self, row: Row, most: int) -> Iterator[tuple]:
        if self.seen < most:
            self.seen += 1
            yield (*row, self.seen)


def register_latest(spark: SparkSession, name: str = "latest_of") -> None:
    """Make the function known to the session's SQL by that name."""
    spark.udtf.register(name, udtf(LatestOf))
