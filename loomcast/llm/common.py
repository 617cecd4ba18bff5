"""What several operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.operators.reliable import components, cut, ensure_checkpoint_dir, remove_folder

__all__ = ["ASCII_SPACE", "components", "cut", "documents", "ensure_checkpoint_dir", "free_name", "let_go", "remove_folder", "spread_join", "stay", "table", "tokenizer_file", "worker_keeps"]

#: ASCII white space, as the operators' contracts name it.
ASCII_SPACE = r"[\x20\x09-\x0D]+"


def free_name(name: str, taken: Iterable[str]) -> str:
    """name with as many underscores before it as it takes to be none of taken, letter case aside."""
    used = {x.lower() for x in taken}
    while name.lower() in used:
        name = "_" + name
    return name


def let_go(spark: SparkSession) -> None:
    """Have the driver collect its garbage, so that Spark removes shuffle files and checkpoints that nothing refers to any more.

    Otherwise they stay until the driver happens to do so; iterative jobs fill disks with them.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: What this Python worker keeps from task to task, and its name.
_kept: list = [None, None]


def worker_keeps(name: object = None, make: Callable[[], Any] = lambda: None) -> Any:
    """What make made under this name, kept for all tasks that the worker runs, until a task keeps another or nothing (no name).

    A worker serves one stage after the other; without this the tables of a stage long done
    fill its memory. What goes is given back to the system.
    """
    if _kept[0] != name:
        _kept[:] = None, None
        gc.collect()
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)
        _kept[:] = name, make()
    return _kept[1]


def spread_join(rows: DataFrame, one_each: DataFrame, on: list[str], salts: int = 4) -> DataFrame:
    """Inner join of rows with a table that has one row for each of on, in which a hot key's rows are dealt to several tasks.

    The rows of a key are dealt over salts by a hash of their content, so that a task that
    runs again deals them alike, and the other table is listed under each.
    """
    salt = free_name("salt", [*rows.columns, *one_each.columns])
    dealt = rows.withColumn(salt, F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int"))
    listed = one_each.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(listed, [*on, salt]).drop(salt)


def stay(docs: DataFrame, id_col: str, marks: DataFrame, class_of: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """One row of docs for each group of marks, with all its columns: a row of the group's smallest id.

    marks has one row per row of docs: (id, cls, grp, least): the class of the row's text,
    its group and the group's smallest id, null if none of its rows has one. class_of adds
    the class to rows of docs, in a column of a given name. Ids that name one row are settled by a join on the id
    alone; class_of runs only for rows whose id is null or repeated, of which one row of
    each group stays.
    """
    marks = cut(marks.withColumn("best", F.col("id").eqNullSafe(F.col("least"))))
    ids = marks.where("id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max("best").alias("any_best")).where("any_best")
    out = docs.join(ids.where("n = 1").select(F.col("id").alias(id_col)), id_col, "left_semi").select(docs.columns)
    repeated = cut(ids.where("n > 1").select(F.col("id").alias(id_col)))
    nameless = marks.where("id is null and best")
    if repeated.isEmpty() and nameless.isEmpty():
        return out
    odd = docs.join(repeated, id_col, "left_semi").select(docs.columns).unionByName(docs.where(F.col(id_col).isNull()))
    here, least, cls, grp = (free_name(x, docs.columns) for x in ("_here", "_least", "_cls", "_grp"))
    wanted = marks.where("best").select(F.col("id").alias(least), F.col("cls").alias(cls), F.col("grp").alias(grp)).distinct()
    met = class_of(odd, here).join(wanted, (F.col(cls) == F.col(here)) & F.col(least).eqNullSafe(F.col(id_col)))
    return out.unionByName(met.dropDuplicates([grp]).select(docs.columns))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file, which is installed alike on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
