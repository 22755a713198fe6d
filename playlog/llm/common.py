"""Small helpers shared by the operators."""

from __future__ import annotations

import ctypes
import functools
import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playlog.session import scratch_path

#: White space between words: space and the control characters tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` below spark.checkpoint.dir and read it back.

    Cuts lineage: a lost executor re-reads the table instead of recomputing the text
    pass, and every later use sees the same rows.  The folder belongs to the run that
    made it and may be removed once that run's result is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shards(spark: SparkSession) -> int:
    """How many hash shards an operator deals its packed rows to: the session's shuffle
    partitions, which the user sizes to the input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(column: str = "text"):
    """A null text counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def slices(batches, rows: int = 256):
    """Arrow batches in parts, so that a worker's lists and results stay small however many
    rows Spark puts into a batch."""
    for b in batches:
        for at in range(0, len(b), rows):
            yield b.slice(at, rows)


def vocabulary(name: str) -> str:
    """Where a public vocabulary file lies, on the driver as on the executors."""
    import public_tokenizers

    return os.path.realpath(public_tokenizers.path(name))


def ranked(rows: DataFrame, by: list, order: list, k: int, salts: int = 64) -> DataFrame:
    """The first `k` rows of every group `by` in `order`, with their `rank` from 1.

    Ranked first among the rows of a salt (the partition that made them, modulo `salts`),
    then among the survivors, so a group with rows from very many tasks is not ranked by
    one task.
    """
    salted = rows.withColumn("_salt", F.spark_partition_id() % salts)
    near = salted.withColumn("rank", F.row_number().over(
        Window.partitionBy(*by, "_salt").orderBy(*order))).where(F.col("rank") <= k)
    return near.drop("_salt").withColumn("rank", F.row_number().over(
        Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


@functools.cache
def _allocator():
    """This process's C library, told to give large blocks back to the system when they are
    freed; Arrow is told to use it.  None where there is no such library."""
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, 4 << 20)   # M_MMAP_THRESHOLD: fixed, else it follows the largest block
        trim = libc.malloc_trim
    except (OSError, AttributeError):
        return None
    pa.set_memory_pool(pa.system_memory_pool())
    return trim


def release() -> None:
    """Give freed memory back, so that a worker that waits for its next task holds little."""
    if (trim := _allocator()) is not None:
        trim(0)


def lean(run):
    """`run` for mapInArrow, giving back its memory at the end."""
    def batches_of(batches):
        _allocator()
        try:
            yield from run(batches)
        finally:
            release()
    return batches_of


def lean_group(run):
    """`run` for applyInArrow on groups, giving back its memory after each."""
    def group(key, table):
        _allocator()
        try:
            return run(key, table)
        finally:
            release()
    return group


def lean_cogroup(run):
    """`run` for applyInArrow on pairs of groups, giving back its memory after each."""
    def groups(key, left, right):
        _allocator()
        try:
            return run(key, left, right)
        finally:
            release()
    return groups
