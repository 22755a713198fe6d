"""Kafka topics as raw-message frames (S1) and catalog changelogs (S2 input).

Both read from the earliest offset by default, in batch (``spark.read``) or streaming
(``spark.readStream``), and are shaped to the columns every operator here expects:
``topic, partition, offset, broker_time, key, value`` with key and value as text.
``minPartitions`` splits big topic partitions over more tasks (the parse is the CPU
cost), ``maxOffsetsPerTrigger`` bounds a micro-batch.  The Kafka connector package must
be on the cluster's classpath; it is not bundled here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_shape(df: DataFrame) -> DataFrame:
    """Kafka source rows → (topic, partition, offset, broker_time, key, value)."""
    return df.select("topic", "partition", "offset", F.col("timestamp").alias("broker_time"),
                     F.col("key").cast("string").alias("key"),
                     F.col("value").cast("string").alias("value"))


def read_topic(spark: SparkSession, bootstrap: str, topic: str, streaming: bool = True,
               starting_offsets: str = "earliest", min_partitions: int | None = None,
               max_offsets_per_trigger: int | None = None,
               options: dict[str, str] | None = None) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    r = (reader.format("kafka").option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    if min_partitions:
        r = r.option("minPartitions", str(min_partitions))
    if streaming and max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return kafka_shape(r.load())
