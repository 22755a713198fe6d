"""Recorded dumps as streams in line order (S3).

A stream has no row numbers, so a first query places the lines: every micro-batch of files is
read in ``foreachBatch``, where a line's place follows from its split's byte offset and its
row in the split, parsed, and written as Kafka-shaped messages to a folder of its own in
the shared folder.  The jobs stream that table.

The offset is the micro-batch, then the line's place in its file.  Files come in the order of
their modification, ``max_files`` a micro-batch: one by default, so that a later file's
lines come after an earlier one's.  Files that share a micro-batch keep their line orders
and are interleaved by place, as in a batch read.

A folder appears by renaming when it is complete and is never written again: a micro-batch
replayed after a failure finds it and leaves it, so no message is read twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from playlog.session import prepare
from playlog.sources import dump
from playlog.streaming.jobs import Trigger, table_stream
from playlog.streaming.sinks import BATCH_COL, folder

#: Bits of the offset below the micro-batch's number: bytes of the largest file.
PLACE_BITS = 44

MESSAGE = T.StructType([
    T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()),
    T.StructField("broker_time", T.TimestampType()), T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()), T.StructField(BATCH_COL, T.IntegerType())])


def place_lines(table: str):
    """``foreachBatch`` function: a micro-batch of ``dump.stream_text`` to messages in ``table``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done, fs = folder(spark, f"{table}/{BATCH_COL}={batch_id}")
        if fs.exists(done):
            return
        numbered = batch.select("topic", "file_name", "split_start",
                                F.monotonically_increasing_id().alias("split_row"), "line")
        messages = dump.as_messages(dump.records(numbered)).withColumn(
            "offset", F.lit(batch_id << PLACE_BITS) + F.col("offset"))
        incoming, _ = folder(spark, f"{table}/_incoming/{batch_id}")
        messages.write.mode("overwrite").parquet(str(incoming))
        if not fs.rename(incoming, done):
            raise OSError(f"{incoming} could not be renamed to {done}")
    return write


def start_messages(spark: SparkSession, dump_folder: str, root: str, trigger: Trigger = Trigger(),
                   max_files: int | None = 1) -> tuple[StreamingQuery, DataFrame]:
    """The query that places a dump folder's lines below ``root``, and the stream of messages."""
    prepare(spark)
    table = f"{root.rstrip('/')}/messages"
    lines = dump.stream_text(spark, dump_folder, max_files)
    query = trigger.start(
        lines.writeStream.foreachBatch(place_lines(table))
        .option("checkpointLocation", f"{root.rstrip('/')}/_placing"), spark)
    return query, table_stream(spark, table, MESSAGE).drop(BATCH_COL)
