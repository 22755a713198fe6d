"""The late-data rule per record on streams (W5), exactly as in batch.

A watermark moves between micro-batches and is one for all source partitions.  Here each
source partition's stream time is kept as arbitrary state (``transformWithState``) and every
record gets the stream time it met, in ingestion order, so that it is judged by
``window_end > stream_time - grace`` like in ``operators.windows``.  An opt-in beside the
watermark jobs, which run in the JVM alone.

* ``with_stream_time`` — keyed by source partition; the state is one number.  A partition's
  rows of one micro-batch are put into offset order in one task, so bound the micro-batch
  (``max_offsets_per_trigger``, ``max_files``) and pass only the columns the aggregate needs.
* ``start_on_time`` — the (event, window) rows that may still count, as an append-only
  table in the shared folder.
* ``start_skip_rate`` — the aggregate over that table, upserted as in ``streaming.jobs``.
  Which windows can still change depends on the slowest partition, so nothing is dropped
  from its state, unless ``lag`` says how far apart the partitions may be.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from playlog import contract as C
from playlog.operators import skip_rate
from playlog.operators.windows import window_bounds, window_of
from playlog.session import prepare
from playlog.streaming import jobs

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Names without a leading underscore: rows reach the state as named tuples.
TIME, STREAM_TIME = "event_time_us__", "stream_time_us__"


class StreamTime(StatefulProcessor):
    """Adds to each row of a source partition the largest event time so far, itself included."""

    def __init__(self, order_col: str):
        self.order_col = order_col

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", T.StructType([T.StructField("us", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(self.order_col, kind="stable")
        times = batch[TIME].to_numpy(np.int64)
        if self.latest.exists():
            times = np.maximum(times, self.latest.get()[0])
        so_far = np.maximum.accumulate(times)
        self.latest.update((int(so_far[-1]),))
        yield batch.assign(**{STREAM_TIME: so_far})

    def close(self) -> None:
        pass


def with_stream_time(events: DataFrame, columns: Sequence[str], domain_col: str = "partition",
                     order_col: str = "offset", time_col: str = "event_time") -> DataFrame:
    """domain, order, event time and ``columns`` of a stream's records, each with the stream time
    it met (``STREAM_TIME``, microseconds).  Records without a time, a position or a domain
    have no stream time and are left out, as are they in the windows."""
    # instants travel as numbers: pandas' own range ends in 2262
    slim = events.where(F.col(time_col).isNotNull() & F.col(order_col).isNotNull()
                        & F.col(domain_col).isNotNull()).select(
        domain_col, order_col, F.unix_micros(time_col).alias(TIME), *columns)
    schema = T.StructType([*slim.schema.fields, T.StructField(STREAM_TIME, T.LongType())])
    timed = slim.groupBy(domain_col).transformWithStateInPandas(
        statefulProcessor=StreamTime(order_col), outputStructType=schema, outputMode="Append",
        timeMode="None")
    return timed.withColumn(time_col, F.timestamp_micros(TIME)).drop(TIME)


def on_time(timed: DataFrame, size: str, slide: str | None, grace: str,
            time_col: str = "event_time") -> DataFrame:
    """One row per (event, window) the event may still update."""
    return (timed.select("*", window_of(time_col, size, slide).alias("window"))
            .where(F.col("window.end") > F.timestamp_micros(STREAM_TIME) - F.expr(f"INTERVAL {grace}"))
            .drop(STREAM_TIME))


def start_on_time(events: DataFrame, paths: jobs.Paths, name: str, columns: Sequence[str], size: str,
                  slide: str | None, grace: str, trigger: jobs.Trigger = jobs.Trigger()
                  ) -> tuple[StreamingQuery, str, T.StructType]:
    """The query that writes the rows on time, its table and the table's schema."""
    spark = prepare(events.sparkSession)
    rows = on_time(with_stream_time(events, columns), size, slide, grace)
    path = f"{paths.root}/on_time/{name}"
    with jobs.session_conf(spark, "spark.sql.streaming.stateStore.providerClass", ROCKSDB):
        query = trigger.start(
            rows.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", paths.checkpoint(f"{name}_on_time")), spark, path)
    return query, path, rows.schema


def on_time_stream(spark: SparkSession, path: str, schema: T.StructType,
                   max_files: int | None = None) -> DataFrame:
    return jobs.table_stream(spark, path, schema, max_files)


def start_skip_rate(valid: DataFrame, paths: jobs.Paths, trigger: jobs.Trigger = jobs.Trigger(),
                    window: str = C.SKIP_WINDOW, grace: str = C.SKIP_GRACE, lag: str | None = None,
                    max_files: int | None = None) -> list[StreamingQuery]:
    """Skip rate with the per-record rule: the on-time rows, then their counts.

    With ``availableNow`` the rows are written out before they are counted.  ``lag`` bounds
    the state of the counts: windows that ended this long before the latest event of
    any partition are final."""
    listened = valid.filter(F.col("event_type").isin("SKIP", "COMPLETE"))
    first, path, schema = start_on_time(listened, paths, "skip_rate", ["event_type", "track_id"],
                                        window, None, grace, trigger)
    if trigger.available_now and not trigger.every:
        first.awaitTermination()
    rows = on_time_stream(valid.sparkSession, path, schema, max_files)
    if lag:
        rows = rows.withWatermark("event_time", lag)
    counts = skip_rate.counters(rows.groupBy("track_id", window_of("event_time", window).alias("window"))
                                if lag else rows.groupBy("track_id", "window"))
    out = counts.select("track_id", *window_bounds(), "skips", "completes", *skip_rate.rate_columns())
    return [first, jobs.upsert(out, "skip_rate", paths, trigger)]
