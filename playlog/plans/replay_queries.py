"""Registered dump queries (S3, O1-O3).

The dump lines are derived from the driver's tables: the raw listening messages and
the catalog changelog, each encoded as ``{key, value, ts_ms}`` JSON lines of its own
topic, then read back by the same parser as dump files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlog.operators import replay
from playlog.session import prepare
from playlog.sources import dump, fixtures

EVENTS_TOPIC = "listening.events"
TRACKS_TOPIC = "catalog.tracks"


def _encode(df: DataFrame, topic: str, ts_ms) -> DataFrame:
    line = F.to_json(F.struct("key", "value", ts_ms.alias("ts_ms")), {"ignoreNullFields": "false"})
    return df.select(F.lit(topic).alias("topic"), F.lit(f"{topic}.jsonl").alias("file_name"),
                     F.lit(0).cast("bigint").alias("split_start"),
                     F.col("offset").alias("split_row"), line.alias("line"))


def fixture_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    from playlog.plans import queries
    raw = queries.raw(spark, sf_dir)
    cat = queries.changelog(spark, sf_dir)
    cat_ts = ((F.lit(fixtures.BASE_EPOCH_S) + F.col("offset")) * 1000).cast("bigint")
    return (_encode(raw, EVENTS_TOPIC, F.unix_millis("broker_time"))
            .unionByName(_encode(cat, TRACKS_TOPIC, cat_ts)))


def dump_records(spark, sf_dir):
    return dump.records(fixture_lines(spark, sf_dir))


def dump_timeline(spark, sf_dir):
    return replay.timeline(dump_records(spark, sf_dir))


def dump_topic_counts(spark, sf_dir):
    return replay.topic_counts(dump_records(spark, sf_dir))


def dump_preview(spark, sf_dir):
    return replay.preview(dump_records(spark, sf_dir))


def registry():
    return {"dump_records": dump_records, "dump_timeline": dump_timeline,
            "dump_topic_counts": dump_topic_counts, "dump_preview": dump_preview}
