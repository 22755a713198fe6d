"""Adapter from the driver's tables to listening-event inputs (see FIXTURES.md).

* ``clean_events_from``  – one listening event per ``events`` row, one second apart, with
  a planted stream farm (``u-farm``/``trk-farm``) and a planted flop (``trk-flop``);
* ``raw_messages``  – the same events as Kafka-shaped JSON messages
  (``partition, offset, broker_time, key, value``) with anomalies planted by
  ``seq % 200``: broken JSON, missing / null / blank fields, bad types, bad enums,
  bad times, late events, exact duplicates, and well-formed oddities that stay valid;
* ``catalog_changelog`` – two versions of every ``part`` row as a compacted
  catalog topic, with tombstones and broken newest versions.

Every row of the driver's tables is used; nothing is sampled.  The row expressions are
SQL text shared with the DuckDB oracle (``playlog.plans.oracle``) so that both sides
build the very same inputs; only the engine-specific heads differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


# 2026-07-04T00:00:00Z, the first event's second.
BASE_EPOCH_S = 1783123200

# ---- listening events -------------------------------------------------------------
SPARK_EVENTS_HEAD = [
    "event_id AS id", "user_id AS uid", "event_type AS et", "value AS v",
    "CAST(get_json_object(props, '$.k') AS INT) AS k",
    f"timestamp_millis(({BASE_EPOCH_S} + event_id) * 1000 + (event_id * 7) % 1000) AS ts",
]
DUCK_EVENTS_HEAD = [
    "event_id AS id", "user_id AS uid", "event_type AS et", "value AS v",
    "CAST(json_extract_string(props, '$.k') AS INT) AS k",
    f"epoch_ms(({BASE_EPOCH_S} + event_id) * 1000 + (event_id * 7) % 1000) AS ts",
]
EVENTS_FLAGS = [
    "*",
    "CAST(floor(id / 1000) AS BIGINT) % 2 = 0 AND id % 10 = 3 AS farm",
    "id % 10 = 5 AS flop",
]
EVENTS_BODY = [
    "id AS seq",
    "'ev-' || CAST(id AS STRING) AS event_id",
    "CASE WHEN farm THEN 'u-farm' ELSE 'u-' || CAST(uid AS STRING) END AS user_id",
    "CASE WHEN farm THEN 'trk-farm' WHEN flop THEN 'trk-flop' "
    "ELSE 'trk-' || CAST(k AS STRING) END AS track_id",
    "CASE WHEN farm THEN 'artist-farm' WHEN flop THEN 'artist-flop' "
    "ELSE 'artist-' || CAST(k % 20 AS STRING) END AS artist",
    "CASE WHEN farm THEN 'COMPLETE' WHEN flop THEN 'SKIP' WHEN et = 'view' THEN 'START' "
    "WHEN et = 'error' THEN 'SKIP' ELSE 'COMPLETE' END AS event_type",
    "CASE WHEN farm THEN 31000 WHEN flop THEN 5000 WHEN et = 'view' THEN 0 "
    "WHEN et = 'error' THEN CAST(floor(v * 300) AS INT) "
    "ELSE CAST(floor(v * 1000) AS INT) END AS ms_played",
    "CASE uid % 6 WHEN 0 THEN 'FR' WHEN 1 THEN 'US' WHEN 2 THEN 'DE' WHEN 3 THEN 'BR' "
    "WHEN 4 THEN 'JP' ELSE 'GB' END AS country",
    "ts",
]

# ---- raw messages -----------------------------------------------------------------
# Per-row anomaly a = seq % 200 (everything else is a clean message):
#  0 no track_id | 1 event_type null | 2 ms_played "douze" | 3 ms_played -5000
#  4 event_type COMPLETEE | 5 timestamp "hier a 15h" | 6 truncated | 7 empty | 8 null
#  9 country XX | 10 late by 90 min (valid) | 11, 13 exact duplicate (valid) | 12 not JSON
# 14 +02:00 offset (valid) | 15 ms_played as text (valid) | 16 ms_played with fraction (valid)
# 17 unknown extra field (valid) | 18 user_id as a number (valid) | 19 blank artist
# 20 no event_id | 21 empty user_id | 22 no timestamp | 23 date-only timestamp
# 24 ms_played beyond INT | 25 ms_played true | 26 track_id an object | 27 array root
# 28 lower-case t / z (valid) | 29 blank instead of T | 30 white space between tokens (valid)
# 31 ms_played null | 32 ms_played "" | 33 country null | 34 ms_played 12.7e3 (valid)
# 35 hour-only offset | 36 artist U+2003 (blank) | 37 artist U+00A0 (not blank: valid)
# 38 event_id twice, first an object | 39 ms_played twice, first "x" | 40 event_id twice (valid)
# 41, 42 event_id the numbers 1.50, 1.5, both paid (valid) | 43 user_id the number 1e3 (valid)
# The broker time lies before 1970 for seq % 400 = 5 (whose own time is unreadable).
SPARK_RAW_HEAD = [
    "*", "seq % 200 AS a",
    "CASE WHEN seq % 200 = 10 THEN ts - INTERVAL 90 MINUTES ELSE ts END AS ets",
]
SPARK_RAW_ISO = [
    "*",
    "date_format(ets, \"yyyy-MM-dd'T'HH:mm:ss.SSS\") AS iso",
    "date_format(ets + INTERVAL 2 HOURS, \"yyyy-MM-dd'T'HH:mm:ss.SSS\") AS iso_p2",
]
DUCK_RAW_HEAD = SPARK_RAW_HEAD
DUCK_RAW_ISO = [
    "*",
    "strftime(ets, '%Y-%m-%dT%H:%M:%S.%g') AS iso",
    "strftime(ets + INTERVAL 2 HOURS, '%Y-%m-%dT%H:%M:%S.%g') AS iso_p2",
]
RAW_JSON = [
    "seq", "a", "user_id", "ts",
    "'{' || CASE a WHEN 38 THEN '\"event_id\":{\"a\":1},' WHEN 40 THEN '\"event_id\":\"first\",'"
    " ELSE '' END || CASE a WHEN 20 THEN '' WHEN 41 THEN '\"event_id\":1.50,'"
    " WHEN 42 THEN '\"event_id\":1.5,' ELSE '\"event_id\":\"' || event_id || '\",' END"
    " || '\"user_id\":' || CASE a WHEN 18 THEN substring(user_id, 3) WHEN 21 THEN '\"\"'"
    " WHEN 43 THEN '1e3'"
    " ELSE '\"' || user_id || '\"' END"
    " || CASE a WHEN 0 THEN '' WHEN 26 THEN ',\"track_id\":{\"id\":\"' || track_id || '\"}'"
    " ELSE ',\"track_id\":\"' || track_id || '\"' END"
    " || ',\"artist\":' || CASE a WHEN 19 THEN '\"  \"' WHEN 36 THEN '\"\u2003\"'"
    " WHEN 37 THEN '\"\u00a0\"' WHEN 41 THEN '\"artist-lit\"' WHEN 42 THEN '\"artist-lit\"' ELSE '\"' || artist || '\"' END"
    " || ',\"event_type\":' || CASE a WHEN 1 THEN 'null' WHEN 4 THEN '\"COMPLETEE\"'"
    " WHEN 41 THEN '\"COMPLETE\"' WHEN 42 THEN '\"COMPLETE\"'"
    " ELSE '\"' || event_type || '\"' END"
    " || ',\"ms_played\":' || CASE a WHEN 2 THEN '\"douze\"' WHEN 3 THEN '-5000'"
    " WHEN 15 THEN '\"' || CAST(ms_played AS STRING) || '\"'"
    " WHEN 16 THEN CAST(ms_played AS STRING) || '.9'"
    " WHEN 24 THEN '99999999999' WHEN 25 THEN 'true' WHEN 31 THEN 'null' WHEN 32 THEN '\"\"'"
    " WHEN 34 THEN '12.7e3' WHEN 39 THEN '\"x\",\"ms_played\":5'"
    " WHEN 41 THEN '45000' WHEN 42 THEN '45000' ELSE CAST(ms_played AS STRING) END"
    " || ',\"country\":' || CASE a WHEN 9 THEN '\"XX\"' WHEN 33 THEN 'null'"
    " ELSE '\"' || country || '\"' END"
    " || CASE a WHEN 22 THEN ''"
    " ELSE ',\"timestamp\":\"' || CASE a WHEN 5 THEN 'hier a 15h'"
    " WHEN 14 THEN iso_p2 || '+02:00' WHEN 35 THEN iso_p2 || '+02' WHEN 23 THEN substring(iso, 1, 10)"
    " WHEN 28 THEN replace(iso, 'T', 't') || 'z' WHEN 29 THEN replace(iso, 'T', ' ') || 'Z'"
    " ELSE iso || 'Z' END || '\"' END"
    " || CASE a WHEN 17 THEN ',\"device\":{\"os\":\"ios\",\"v\":[1,2]}' ELSE '' END"
    " || '}' AS js",
]
RAW_VALUE = [
    "seq", "a", "user_id AS key", "ts",
    "CASE a WHEN 6 THEN substring(js, 1, 15) WHEN 7 THEN '' WHEN 8 THEN CAST(NULL AS STRING)"
    " WHEN 12 THEN 'poison' WHEN 27 THEN '[' || js || ']'"
    " WHEN 30 THEN replace(replace(js, ',\"', ' ,\n  \"'), '\":', '\" :  ')"
    " ELSE js END AS value",
    "CASE WHEN a IN (11, 13) THEN 2 ELSE 1 END AS copies",
]
# Duplicates: one more copy of the message right after the first (engine-specific explode).
SPARK_RAW_COPIES = ["*", "explode(sequence(1, copies)) AS copy"]
DUCK_RAW_COPIES = ["*", "unnest(generate_series(1, copies)) AS copy"]
RAW_OUT = [
    "seq", "a AS anomaly",
    "CAST(seq % 6 AS INT) AS {partition}",
    "CAST(2 * seq + copy - 1 AS BIGINT) AS {offset}",
    "CASE WHEN seq % 400 = 5 THEN ts - INTERVAL 60 YEARS ELSE ts END AS broker_time",
    "key", "value",
]

# ---- catalog changelog --------------------------------------------------------------
# Two versions per part row; newest is a tombstone when p_partkey % 30 = 0 and
# unreadable when p_partkey % 50 = 7 (so the older version stays current).
SPARK_CAT_VERSIONS = ["*", "explode(sequence(0, 1)) AS ver"]
DUCK_CAT_VERSIONS = ["*", "unnest(generate_series(0, 1)) AS ver"]
CAT_BODY = [
    "CAST(p_partkey % 3 AS INT) AS {partition}",
    "CAST(2 * p_partkey + ver AS BIGINT) AS {offset}",
    "'trk-' || CAST(p_partkey AS STRING) AS key",
    "CASE WHEN ver = 1 AND p_partkey % 30 = 0 THEN CAST(NULL AS STRING)"
    " WHEN ver = 1 AND p_partkey % 50 = 7 THEN '{\"track_id\":\"trk-' || CAST(p_partkey AS STRING)"
    " ELSE '{\"track_id\":\"trk-' || CAST(p_partkey AS STRING) || '\",\"title\":\"' || p_name"
    " || CASE WHEN ver = 0 THEN ' (old)' ELSE '' END"
    " || '\",\"artist\":\"artist-' || CAST(p_partkey % 20 AS STRING) || '\",\"genre\":\"' || p_type"
    " || '\",\"duration_ms\":' || CAST(180000 + p_size * 1000 AS STRING) || '}' END AS value",
]


def quoted(exprs: list[str], quote: str) -> list[str]:
    """Fill the ``{partition}`` / ``{offset}`` identifiers with the engine's quoting."""
    return [e.replace("{partition}", f"{quote}partition{quote}")
             .replace("{offset}", f"{quote}offset{quote}") for e in exprs]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _input(spark: SparkSession, sf_dir: str, name: str, columns) -> DataFrame:
    """A driver table as a parse input: only the needed columns.

    Split size (``spark.sql.files.maxPartitionBytes``) gives the parse its parallelism.
    ``spark.playlog.inputPartitions``, if set, deals every input to exactly that many
    partitions (for a table of one small file); the plan never depends on the data.
    """
    df = _table(spark, sf_dir, name).select(*columns)
    n = spark.conf.get("spark.playlog.inputPartitions", None)
    return df.repartition(int(n)) if n else df


EVENTS_INPUT = ("event_id", "user_id", "event_type", "value", "props")
PART_INPUT = ("p_partkey", "p_name", "p_type", "p_size")


def clean_events_from(events: DataFrame) -> DataFrame:
    """Listening events (typed, valid) from an ``events``-shaped frame (batch or stream)."""
    return (events.selectExpr(*SPARK_EVENTS_HEAD).selectExpr(*EVENTS_FLAGS)
                  .selectExpr(*EVENTS_BODY))


def raw_messages_from(events: DataFrame) -> DataFrame:
    """Kafka-shaped raw messages from an ``events``-shaped frame (batch or stream)."""
    return (clean_events_from(events)
            .selectExpr(*SPARK_RAW_HEAD).selectExpr(*SPARK_RAW_ISO)
            .selectExpr(*RAW_JSON).selectExpr(*RAW_VALUE)
            .selectExpr(*SPARK_RAW_COPIES).selectExpr(*quoted(RAW_OUT, "`")))


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_messages_from(_input(spark, sf_dir, "events", EVENTS_INPUT))


def catalog_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compacted-topic changelog of the track catalog: partition, offset, key, value."""
    part = _input(spark, sf_dir, "part", PART_INPUT)
    return part.selectExpr(*SPARK_CAT_VERSIONS).selectExpr(*quoted(CAT_BODY, "`"))


def events_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int = 1,
                  min_partitions: int | None = None) -> DataFrame:
    """The ``events`` table as a file stream (file streams need a directory or a glob),
    spread over ``min_partitions`` tasks (default: the task slots), as Kafka's
    ``minPartitions`` does, so the parse of a micro-batch is not one task."""
    schema = _table(spark, sf_dir, "events").schema
    stream = (spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(f"{sf_dir.rstrip('/')}/events*.parquet"))
    slots = min_partitions or spark.sparkContext.defaultParallelism
    return stream.select(*EVENTS_INPUT).repartition(slots)


def part_stream(spark: SparkSession, sf_dir: str, min_partitions: int | None = None) -> DataFrame:
    """The ``part`` table as a file stream, spread like ``events_stream``."""
    schema = _table(spark, sf_dir, "part").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/part*.parquet")
    slots = min_partitions or spark.sparkContext.defaultParallelism
    return stream.select(*PART_INPUT).repartition(slots)


__all__ = ["raw_messages", "catalog_changelog", "clean_events_from",
           "raw_messages_from", "events_stream", "part_stream"]
