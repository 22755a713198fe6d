"""Reports over recorded dumps (O1-O3).

* ``timeline`` — all topics merged by time: every record's ``rank`` in a stable global
  order on (ts_ms, file name, position in file), i.e. what a k-way merge of time-sorted
  files yields.  Range partitions are sorted and counted; no task sees all records.
* ``topic_counts`` — messages per topic, listed by topic name.
* ``preview`` — every message as ``topic | key | first 110 characters of value``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlog import contract as C
from playlog.session import staged
from playlog.sources.dump import POSITION

ROW_BITS = 33   # of monotonically_increasing_id: the row's number in its partition


def timeline(records: DataFrame) -> DataFrame:
    """O1: rank (from 1), ts_ms, topic, key, value in merge order (ts_ms, then file, then
    position in the file).  The rank is the order; sort by it where lines are shown.

    The records are staged first, so that the range bounds are sampled from stored times
    and positions and nothing is parsed twice.  The sorted range partitions are staged with
    the partition's and the row's number; a prefix sum over the partitions' counts, one
    row each, turns these into ranks.
    """
    kept = staged(records.select("ts_ms", *POSITION, "topic", "key", "value"), "timeline-records")
    placed = staged(
        kept.repartitionByRange("ts_ms", *POSITION).sortWithinPartitions("ts_ms", *POSITION)
        .select("ts_ms", "topic", "key", "value", F.spark_partition_id().alias("_part"),
                F.monotonically_increasing_id().bitwiseAND((1 << ROW_BITS) - 1).alias("_row")),
        "timeline-ranges")
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    past = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_part", F.coalesce(F.sum("_n").over(past), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(before), "_part").select(
        (F.col("_before") + F.col("_row") + 1).alias("rank"), "ts_ms", "topic", "key", "value")


def topic_counts(records: DataFrame) -> DataFrame:
    """O2: (topic, messages) ordered by topic."""
    return (records.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))
                   .orderBy("topic"))


def preview(records: DataFrame, width: int = C.PREVIEW_CHARS) -> DataFrame:
    """O3: one display line per message, the value cut to ``width`` characters."""
    cut = F.substring(F.col("value"), 1, width)
    line = F.concat_ws(" | ", F.col("topic"), F.coalesce(F.col("key"), F.lit("None")),
                       F.coalesce(cut, F.lit("None")))
    return records.select("topic", "key", cut.alias("value_preview"), line.alias("line"))
