"""Exact deduplication as a stream with disk-backed keyed state.

Texts are equal when they are identical without white space.  Of equal texts the row with
the most code points in its own text stays, then the smallest key, then the first locator.

1. The documents' Parquet files are read as a stream.  Each row becomes (key, digest,
   n_chars, locator); the locator is the row's file and its place there.  The file sink
   writes these narrow rows exactly once, so a text is read once here.
2. A second stream groups the narrow rows by digest.  The grouping's state store (RocksDB,
   on the executors' disks, checkpointed below the shared folder) keeps per digest the row
   that stays (key, length, locator) and the number of rows.  Nothing expires.
3. The state is read back as a table.  For digests of several rows the whole texts are
   read again and compared: per digest the least and the greatest normalised text, taken
   in every task before the shuffle, must be the same bytes.  Where they are not (two texts
   with one digest), those rows are grouped by their full texts instead.
4. The narrow rows get their class's result by a join on the digest.

`exact_dedup` can be called again with the same `root` when files were added: both streams
go on from their checkpoints, and only the new files are digested.

Everything is Spark SQL: no Python runs on the executors.  The hit digests are broadcast
only if `bounded_broadcast`'s limit holds for them; beyond it the texts are merge-joined.

Defined results: a null text counts as empty, and all texts without anything but white
space are equal; every row is a row of its own, also if keys repeat or are null, a null key
being the smallest; whole texts of any length are compared; an empty table gives an empty
result; extra columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playlog.llm.common import SPACE, staged, text_of
from playlog.operators.joins import ROW_OVERHEAD_BYTES, bounded_broadcast
from playlog.session import scratch_path

#: The state lives in RocksDB; memtables and block cache of one executor are bounded.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # a store would otherwise reserve some MB for its logs, however small it is
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
DIGEST_BYTES = 32


@contextmanager
def _conf(spark: SparkSession, values: dict[str, str]):
    """Settings that a stream takes over when it starts, and a reader of its state."""
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def normalised(text: str = "text") -> Column:
    """The text without white space."""
    return F.regexp_replace(text_of(text), SPACE, "")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _rows(docs: DataFrame, key: str, text: str, digest: Callable[[Column], Column],
          texts: bool = False) -> DataFrame:
    """(key, digest, n_chars, locator) of each row, and its normalised text if asked for."""
    place = docs.metadataColumn("_metadata")
    plain = docs.select(
        F.col(key).alias("key"), F.char_length(text_of(text)).cast("long").alias("n_chars"),
        F.struct(place["file_path"].alias("file"), place["row_index"].alias("row"))
        .alias("locator"), normalised(text).alias("t"))
    return plain.select("key", digest(F.col("t")).alias("digest"), "n_chars", "locator",
                        *["t"] * texts)


def _stays() -> Column:
    """What a class keeps of its rows: the least of these is the row that stays."""
    return F.min(F.struct((-F.col("n_chars")).alias("shorter"), "key", "locator")).alias("stays")


def _drain(stream: DataFrame, checkpoint: str, **sink) -> None:
    with _conf(stream.sparkSession, STATE_CONF):
        query = (stream.writeStream.option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start(**sink))
    query.awaitTermination()


def state_of(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(digest, stays, group_size): what the grouping's state store holds now."""
    stored = spark.read.format("statestore").load(checkpoint)
    stays, size = stored.schema["value"].dataType.names
    return stored.select(F.col("key")["digest"].alias("digest"),
                         F.col("value")[stays].alias("stays"),
                         F.col("value")[size].alias("group_size"))


def exact_dedup(spark: SparkSession, files: str, key: str = "doc_id", text: str = "text",
                digest: Callable[[Column], Column] = sha256, root: str | None = None,
                files_per_batch: int | None = None) -> DataFrame:
    """key, digest, n_chars, keep_key, group_size, kept of each row of the Parquet `files` (a
    folder or a glob).  `root` is a folder below the shared one that holds narrow rows
    and state; `files_per_batch` bounds a micro-batch."""
    root = root or scratch_path(spark, "llm", "exact-dedup")
    table = spark.read.parquet(files)
    source = spark.readStream.schema(table.schema)
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    narrow = _rows(source.parquet(files), key, text, digest)
    _drain(narrow, f"{root}/_rows", format="parquet", path=f"{root}/rows")
    grouped = spark.readStream.schema(narrow.schema).parquet(f"{root}/rows").groupBy(
        "digest").agg(_stays(), F.count(F.lit(1)).alias("group_size"))
    _drain(grouped, f"{root}/_classes", format="noop", outputMode="update")

    rows = spark.read.schema(narrow.schema).parquet(f"{root}/rows")
    with _conf(spark, STATE_CONF):
        classes = staged(state_of(spark, f"{root}/_classes"), "exact-classes")
    hits = classes.where("group_size > 1").select("digest")
    bound = hits.count() * (DIGEST_BYTES + ROW_OVERHEAD_BYTES)
    texts = _rows(table, key, text, digest, texts=True).join(
        bounded_broadcast(hits, bound), "digest", "left_semi")
    mixed = staged(texts.groupBy("digest").agg(F.min("t").alias("a"), F.max("t").alias("z"))
                   .where("a <> z").select("digest"), "exact-mixed")
    if not mixed.isEmpty():
        return _verdicts(rows.join(mixed, "digest", "left_anti"), classes, ["digest"]).unionByName(
            _by_text(texts.join(mixed, "digest", "left_semi")))
    return _verdicts(rows, classes, ["digest"])


def _by_text(texts: DataFrame) -> DataFrame:
    """The verdicts on rows whose digests stand for several texts."""
    classes = texts.groupBy("digest", "t").agg(
        _stays(), F.count(F.lit(1)).alias("group_size"))
    return _verdicts(texts, classes, ["digest", "t"])


def _verdicts(rows: DataFrame, classes: DataFrame, on: list[str]) -> DataFrame:
    return rows.join(classes, on).select(
        "key", "digest", "n_chars", F.col("stays.key").alias("keep_key"), "group_size",
        (F.col("locator") == F.col("stays.locator")).alias("kept"))
