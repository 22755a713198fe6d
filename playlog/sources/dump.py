"""Recorded topic dumps (S3): one ``<topic>.jsonl`` file per topic, one JSON object per
line ``{"key": ..., "value": ..., "ts_ms": ...}``.

Reading rules: surrounding white space is ignored and blank lines are skipped;
``ts_ms`` missing, null, false, 0 or "" reads as 0, true as 1, a number is truncated
to an integer, a text of digits (with optional sign and ``_`` separators) is read as
that integer; ``value`` missing reads as ""; the topic is the file name without
``.jsonl``.  A line that is not one such object, or more than one, is set aside (``unreadable``) instead of
stopping the whole read.

Batch: ``spark.read.text``.  Streaming: ``spark.readStream.text`` on the same folder, its lines
put in place by ``streaming.dumps``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlog.functions.jsonparse import fence, more_than_one_value

_WS = r"[\p{javaWhitespace}\x{85}\x{A0}\x{2007}\x{202F}]"
LINE_SCHEMA = T.StructType([
    T.StructField("key", T.VariantType()), T.StructField("value", T.VariantType()),
    T.StructField("ts_ms", T.VariantType()), T.StructField("_corrupt_record", T.StringType()),
])
RECORD_COLUMNS = ("topic", "file_name", "split_start", "split_row", "key", "value", "ts_ms")
# A line's place in its file: the byte offset of the file split it was read from, then
# its row id inside that split's task (increasing in file order within one split).
POSITION = ("file_name", "split_start", "split_row")


def _lines(text: DataFrame) -> DataFrame:
    """Raw text rows → (topic, file_name, split_start, line)."""
    return text.select(
        F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.jsonl$", 1).alias("topic"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.col("value").alias("line"))


def read_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every ``*.jsonl`` line of a dump folder with its topic and position."""
    return _lines(spark.read.text(f"{folder.rstrip('/')}/*.jsonl")).withColumn(
        "split_row", F.monotonically_increasing_id())


def stream_text(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """The lines of new ``*.jsonl`` files of the folder as they appear, ``max_files`` files a
    micro-batch at most; without row numbers, which a stream does not have."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _lines(reader.text(f"{folder.rstrip('/')}/*.jsonl"))


def stream_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``stream_text`` in the shape of ``read_lines``: ``split_row`` is null, so these lines have no
    order.  ``streaming.dumps`` keeps it."""
    return stream_text(spark, folder).withColumn("split_row", F.lit(None).cast("bigint"))


def _ts_ms(v: Column) -> tuple[Column, Column]:
    t = F.schema_of_variant(v)
    s = F.regexp_replace(F.regexp_replace(F.try_variant_get(v, "$", "string"),
                                          f"^{_WS}+|{_WS}+$", ""), "_", "")
    as_num = F.try_variant_get(v, "$", "double")
    value = (F.when(v.isNull() | (t == "VOID"), F.lit(0))
             .when(t == "BOOLEAN", F.when(F.try_variant_get(v, "$", "boolean"), 1).otherwise(0))
             .when(t == "BIGINT", F.try_variant_get(v, "$", "bigint"))
             .when((t == "DOUBLE") | t.startswith("DECIMAL"), as_num.try_cast("bigint"))
             .when((t == "STRING") & (F.try_variant_get(v, "$", "string") == ""), F.lit(0))
             .when((t == "STRING") & F.try_variant_get(v, "$", "string")
                   .rlike(r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"), s.try_cast("bigint")))
    return value.cast("bigint"), value.isNull()


def parse_lines(lines: DataFrame) -> DataFrame:
    """Lines → records (topic, position, key, value, ts_ms, blank, unreadable).

    Nothing is filtered before the fence: a filter there would be pushed into whatever
    produced the lines and re-evaluate it inside the predicate.
    """
    stripped = F.regexp_replace(F.col("line"), f"^{_WS}+|{_WS}+$", "")
    staged = lines.select("topic", *POSITION, stripped.alias("_s"))
    parsed = staged.select("topic", *POSITION, (F.col("_s") == "").alias("blank"),
                           (F.startswith("_s", F.lit("{")) & F.endswith("_s", F.lit("}")))
                           .alias("_whole"), more_than_one_value(F.col("_s")).alias("_more"),
                           F.from_json("_s", LINE_SCHEMA, {
                               "mode": "PERMISSIVE", "allowSingleQuotes": "false"}).alias("_r"))
    r = F.col("_r")
    v_type = F.schema_of_variant(r.value)
    ts, ts_bad = _ts_ms(r.ts_ms)
    value = F.when(r.value.isNull(), F.lit("")).otherwise(F.try_variant_get(r.value, "$", "string"))
    bad = (~F.col("_whole") | F.col("_more") | r.isNull() | r._corrupt_record.isNotNull() | ts_bad
           | F.coalesce(~v_type.isin("STRING", "VOID"), F.lit(False)))
    return fence(parsed.select(
        "topic", *POSITION,
        F.try_variant_get(r.key, "$", "string").alias("key"),
        value.alias("value"), ts.alias("ts_ms"), "blank",
        (~F.col("blank") & bad).alias("unreadable")))


def records(lines: DataFrame) -> DataFrame:
    """Readable records only (blank lines skipped, unreadable ones set aside)."""
    return (parse_lines(lines).filter(~F.col("blank") & ~F.col("unreadable"))
            .select(*RECORD_COLUMNS))


def read_dump(spark: SparkSession, folder: str) -> DataFrame:
    return records(read_lines(spark, folder))


def as_messages(recs: DataFrame) -> DataFrame:
    """Dump records as Kafka-shaped messages for the jobs.

    A replay publishes a topic's file line by line with ``ts_ms`` as broker time, so the
    line order is the ingestion order.  The offset is the split's byte offset plus
    the line's number in its task: it grows with the line order of a file, as a line takes
    at least one byte and only the last, short split of a file shares a task with others.
    """
    line = F.col("split_start") + F.col("split_row").bitwiseAND((1 << 33) - 1)
    return recs.select(F.lit(0).alias("partition"), line.alias("offset"),
                       F.timestamp_millis("ts_ms").alias("broker_time"), "key", "value")
