"""Structured Streaming jobs (W6, W8, K1-K5): the batch operators, unchanged, on streams.

Layout (one checkpoint per query, all under a shared root):

* ``start_validation`` — raw messages → parse once → file sink partitioned by
  ``status`` (``valid`` / ``dead_letter``), append mode, exactly-once through the
  sink's log.  The ``dead_letter`` part is the DLQ (original text + reason + JSON).
* ``start_catalog`` — catalog changelog → latest state per key (update mode, upsert).
* ``start_skip_rate`` / ``start_top`` / ``start_royalties`` / ``start_fraud`` — each
  streams the ``valid`` part, sets the event-time watermark to the reference's grace,
  aggregates in update mode (results published as input arrives, not at window close)
  and upserts every micro-batch.  Stateful aggregations cannot share one query, so the
  four are separate queries reading the parsed table: the JSON is parsed once.
* The top query joins the catalog inside ``foreachBatch``, after aggregation, with the
  catalog state current at that micro-batch (as a replicated lookup table would).

A watermark is the maximum event time over all input partitions minus the grace, and
advances only between micro-batches: compared with a per-record rule on one global
stream time it drops at most as much (possibly less); a partition far behind the
others can lose more than under its own stream time.  See README.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from playlog import contract as C
from playlog.functions.jsonparse import to_json_text
from playlog.functions.validation import EVENT_COLUMNS, validate
from playlog.operators import catalog, fraud, royalties, skip_rate, top_country
from playlog.operators.joins import bounded_broadcast, size_bound
from playlog.operators.windows import window_bounds
from playlog.session import prepare
from playlog.streaming.sinks import (
    BATCH_COL,
    batches,
    get_text,
    numbered,
    publish,
    put_text,
    read_table,
    upsert_batch,
)

STATUS_VALID = "valid"
STATUS_DEAD = "dead_letter"


@contextmanager
def session_conf(spark: SparkSession, key: str, value):
    """Set a session conf for the duration of a query start (a stream keeps the values
    it started with)."""
    if value is None:
        yield
        return
    old = spark.conf.get(key, None)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


@dataclass
class Trigger:
    """How a query runs: ``availableNow`` (drain what is there, then stop) or a
    processing-time period; ``state_partitions`` fixes the number of state / shuffle
    partitions of a stateful query at its first start (None: the session's setting)."""
    available_now: bool = True
    every: str | None = None
    state_partitions: int | None = None

    def apply(self, writer):
        if self.every:
            return writer.trigger(processingTime=self.every)
        return writer.trigger(availableNow=True) if self.available_now else writer

    def start(self, writer, spark: SparkSession, path: str | None = None) -> StreamingQuery:
        with session_conf(spark, "spark.sql.shuffle.partitions", self.state_partitions):
            w = self.apply(writer)
            return w.start(path) if path else w.start()


@dataclass
class KafkaOut:
    """Publish the keyed outputs and the DLQ to Kafka topics ``<group>.[<ns>.]<suffix>``
    instead of upsert tables (update mode; the topics act as changelogs)."""
    bootstrap: str
    group: str = C.DEFAULT_GROUP
    namespace: str = ""

    def topic(self, kind: str) -> str:
        return C.output_name(kind, self.group, self.namespace)


@dataclass
class Paths:
    root: str
    validated: str = field(init=False)
    catalog: str = field(init=False)
    kafka: KafkaOut | None = None
    group: str = C.DEFAULT_GROUP
    namespace: str = ""

    def __post_init__(self):
        self.root = self.root.rstrip("/")
        self.validated = f"{self.root}/validated"
        self.catalog = f"{self.root}/catalog"

    def out(self, kind: str) -> str:
        return f"{self.root}/out/{C.output_name(kind, self.group, self.namespace)}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"


def validated_table(raw: DataFrame) -> DataFrame:
    """Query 0's rows: every message once, with its status."""
    v = validate(raw)
    dead = F.col("reason").isNotNull()
    meta = [c for c in ("partition", "offset", "key") if c in raw.columns]
    return v.select(
        F.when(dead, F.lit(STATUS_DEAD)).otherwise(F.lit(STATUS_VALID)).alias("status"),
        *meta, *EVENT_COLUMNS, "reason",
        F.when(dead, F.col("value")).alias("original"),
        F.when(dead, to_json_text(F.col("value").alias("original"), "reason")).alias("dlq_value"))


def start_dlq_to_kafka(spark: SparkSession, paths: Paths, schema, trigger: Trigger = Trigger(),
                       max_files: int | None = None) -> StreamingQuery:
    """K1 on Kafka: the dead letters, keyed by the original key, value = DLQ JSON."""
    dead = (table_stream(spark, paths.validated, schema, max_files)
            .filter(F.col("status") == STATUS_DEAD)
            .select(F.col("key"), F.col("dlq_value").alias("value")))
    w = (dead.writeStream.format("kafka").option("kafka.bootstrap.servers", paths.kafka.bootstrap)
         .option("topic", paths.kafka.topic("dlq")).outputMode("append")
         .option("checkpointLocation", paths.checkpoint("dlq_kafka")))
    return trigger.start(w, spark)


def start_validation(raw_stream: DataFrame, paths: Paths, trigger: Trigger = Trigger()
                     ) -> StreamingQuery:
    prepare(raw_stream.sparkSession)
    w = (validated_table(raw_stream).writeStream.format("parquet").partitionBy("status")
         .option("checkpointLocation", paths.checkpoint("validation")).outputMode("append"))
    return trigger.start(w, raw_stream.sparkSession, paths.validated)


def _ensure_dir(spark: SparkSession, path: str) -> None:
    """Create ``path`` on its file system (HDFS, object store, local) if missing, so a
    reader can start before the writer's first micro-batch."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hpath)


def table_stream(spark: SparkSession, path: str, schema,
                  max_files: int | None = None) -> DataFrame:
    """The validated table as a stream; ``max_files`` bounds a micro-batch."""
    _ensure_dir(spark, path)
    r = spark.readStream.schema(schema)
    return (r.option("maxFilesPerTrigger", max_files) if max_files else r).parquet(path)


def validated_schema(raw_stream: DataFrame):
    t = validated_table(raw_stream)
    cols = [f for f in t.schema.fields if f.name != "status"]
    from pyspark.sql.types import StringType, StructField, StructType
    return StructType(cols + [StructField("status", StringType(), True)])


def valid_stream(spark: SparkSession, paths: Paths, schema,
                 max_files: int | None = None) -> DataFrame:
    s = table_stream(spark, paths.validated, schema, max_files)
    return s.filter(F.col("status") == STATUS_VALID).select(
        *[c for c in ("partition", "offset") if c in s.columns], *EVENT_COLUMNS)


def dead_letters(spark: SparkSession, paths: Paths) -> DataFrame:
    """K1 as a table: the DLQ rows written so far."""
    t = spark.read.parquet(paths.validated)
    return t.filter(F.col("status") == STATUS_DEAD).select(
        *[c for c in ("partition", "offset", "key") if c in t.columns],
        "original", "reason", "dlq_value")


def upsert(df: DataFrame, kind: str, paths: Paths, trigger: Trigger,
           grace: str | None = None) -> StreamingQuery:
    """Update-mode output of one keyed result: upsert table, or Kafka changelog topic.
    ``grace``: the watermark delay of a windowed result."""
    if paths.kafka is not None:
        w = (publish(df, kind).writeStream.format("kafka")
             .option("kafka.bootstrap.servers", paths.kafka.bootstrap)
             .option("topic", paths.kafka.topic(kind)))
    else:
        w = df.writeStream.foreachBatch(
            upsert_batch(paths.out(kind), C.UPSERT_KEYS[kind], grace=grace))
    w = w.outputMode("update").option("checkpointLocation", paths.checkpoint(kind))
    return trigger.start(w, df.sparkSession)


def start_skip_rate(valid: DataFrame, paths: Paths, trigger: Trigger = Trigger(),
                    window: str = C.SKIP_WINDOW, grace: str = C.SKIP_GRACE) -> StreamingQuery:
    counters = skip_rate.skip_counters(valid.withWatermark("event_time", grace), window)
    out = counters.select("track_id", *window_bounds(), "skips", "completes",
                          *skip_rate.rate_columns())
    return upsert(out, "skip_rate", paths, trigger, grace)


CATALOG_TEXTS = ("key", "title", "artist", "genre")


def start_catalog(changelog_stream: DataFrame, paths: Paths, trigger: Trigger = Trigger()
                  ) -> StreamingQuery:
    """Latest state per catalog key, deletions kept as ``deleted`` rows; each micro-batch also
    leaves the state's version and the bound of its size (``CatalogSide`` reads them)."""
    tracks = catalog.parse_tracks(changelog_stream)
    usable = tracks.filter(F.col("value").isNull() | F.col("readable"))
    state = F.struct(F.col("value").isNull().alias("deleted"),
                     *[F.col(f) for f in catalog.TRACK_FIELDS])
    cur = usable.groupBy("key").agg(F.max_by(state, F.struct("partition", "offset")).alias("s"))
    out = cur.select("key", *[F.col(f"s.{f}").alias(f) for f in ("deleted",) + catalog.TRACK_FIELDS])
    w = (out.writeStream.foreachBatch(catalog_batch(paths)).outputMode("update")
         .option("checkpointLocation", paths.checkpoint("catalog")))
    return trigger.start(w, out.sparkSession)


def catalog_batch(paths: Paths):
    """``foreachBatch`` function of the catalog: the state, then its version and size bound."""
    write = upsert_batch(paths.catalog, ["key"])

    def write_version(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        spark = batch.sparkSession
        added = size_bound(spark.read.parquet(f"{paths.catalog}/{BATCH_COL}={batch_id}"), *CATALOG_TEXTS)
        # a batch that holds the whole state says it all; others add to the version before
        whole = batches(spark, paths.catalog)[1][-1:] == [batch_id]
        before = None if whole else catalog_version(spark, paths, batch_id)
        put_text(spark, f"{paths.catalog}/{VERSIONS}/{batch_id}", str(added + (before or (0, 0))[1]))
    return write_version


VERSIONS = "_versions"


def catalog_version(spark: SparkSession, paths: Paths, before: int | None = None
                    ) -> tuple[int, int] | None:
    """(version, bound of the state's bytes) of the newest catalog batch, or of the newest one
    ``before`` another."""
    ids = [i for i in numbered(spark, f"{paths.catalog}/{VERSIONS}") if before is None or i < before]
    if not ids:
        return None
    return ids[-1], int(get_text(spark, f"{paths.catalog}/{VERSIONS}/{ids[-1]}"))


def current_catalog(spark: SparkSession, paths: Paths) -> DataFrame | None:
    """The catalog's rows, or None as long as none was written (every track is then
    uncatalogued).  Any error while reading it fails the micro-batch."""
    if not batches(spark, paths.catalog)[0]:
        return None
    state = read_table(spark, paths.catalog, ["key"])
    return state.filter(~F.col("deleted")).drop("deleted")


class CatalogSide:
    """The lookup side of the catalog as it stands at a micro-batch.

    The state is read once per version and kept (in memory and on the executors' disks) until a
    newer one is there; whether it is broadcast follows from the bound the catalog query
    left with it.  A state without a version (written by ``upsert_batch`` alone) is known by its
    newest batch and measured when it is read.
    """

    def __init__(self, paths: Paths):
        self.paths, self.version, self.side, self.bound = paths, None, None, 0

    def __call__(self, spark: SparkSession) -> DataFrame:
        version = catalog_version(spark, self.paths)
        if version is None and (ids := batches(spark, self.paths.catalog)[0]):
            version = ids[-1], None
        if self.side is None or version != self.version:
            if self.side is not None:
                self.side.unpersist()
            cur = current_catalog(spark, self.paths) if version else None
            if cur is None:
                cur = spark.createDataFrame([], "key string, title string, artist string, genre string")
            self.version = version
            self.side = cur.select(F.col("key").alias("_track_key"), "title", "artist", "genre",
                                   F.lit(True).alias("_in_catalog")).persist()
            self.bound = version[1] if version else 0
            if self.bound is None:
                self.bound = size_bound(self.side, "_track_key", "title", "artist", "genre")
        return bounded_broadcast(self.side, self.bound)


def start_top(valid: DataFrame, paths: Paths, trigger: Trigger = Trigger(),
              size: str = C.TOP_WINDOW, slide: str = C.TOP_SLIDE, grace: str = C.TOP_GRACE
              ) -> StreamingQuery:
    counts = top_country.listen_counts(valid.withWatermark("event_time", grace), size, slide)
    out_path = paths.out("top_by_country")
    write = upsert_batch(out_path, C.UPSERT_KEYS["top_by_country"], grace=grace)
    catalog_now = CatalogSide(paths)

    def enrich_and_write(batch: DataFrame, batch_id: int) -> None:
        enriched = top_country.enrich(batch, catalog_now(batch.sparkSession))
        if paths.kafka is None:
            write(enriched, batch_id)
        else:   # at-least-once, like the Kafka sink itself
            (publish(enriched, "top_by_country").write.format("kafka")
             .option("kafka.bootstrap.servers", paths.kafka.bootstrap)
             .option("topic", paths.kafka.topic("top_by_country")).save())

    w = (counts.writeStream.outputMode("update").foreachBatch(enrich_and_write)
         .option("checkpointLocation", paths.checkpoint("top_by_country")))
    return trigger.start(w, counts.sparkSession)


def start_royalties(valid: DataFrame, paths: Paths, trigger: Trigger = Trigger(),
                    dedup_ttl: str | None = None) -> StreamingQuery:
    """Unbounded de-duplication state by default (every event_id ever paid is kept, as
    in the reference); ``dedup_ttl`` bounds it with ``dropDuplicatesWithinWatermark``
    (memory for the risk of paying a duplicate that arrives later than the ttl)."""
    paid = royalties.eligible(valid).select("artist", "event_id", "event_time")
    if dedup_ttl:
        paid = (paid.withWatermark("event_time", dedup_ttl)
                    .dropDuplicatesWithinWatermark(["artist", "event_id"]))
    else:
        paid = paid.dropDuplicates(["artist", "event_id"])
    per_artist = paid.groupBy("artist").agg(F.count(F.lit(1)).alias("paid_streams"))
    out = per_artist.select("artist", "paid_streams",
                            royalties.money(F.col("paid_streams")).alias("total"))
    return upsert(out, "royalties", paths, trigger)


def start_fraud(valid: DataFrame, paths: Paths, trigger: Trigger = Trigger(),
                window_minutes: int = C.FRAUD_WINDOW_MINUTES, grace: str = C.FRAUD_GRACE,
                threshold: int = C.FRAUD_THRESHOLD) -> StreamingQuery:
    counts = fraud.complete_counts(valid.withWatermark("event_time", grace), window_minutes)
    out = (counts.filter(F.col("count") > threshold)
                 .select("user_id", "track_id", "count", *window_bounds()))
    return upsert(out, "fraud_alerts", paths, trigger, grace)


KINDS = ("skip_rate", "top_by_country", "royalties", "fraud_alerts")


def run(spark: SparkSession, raw_stream: DataFrame, paths: Paths,
        changelog_stream: DataFrame | None = None, trigger: Trigger = Trigger(),
        kinds=KINDS, wait: bool = True, fraud_window_minutes: int = C.FRAUD_WINDOW_MINUTES,
        dedup_ttl: str | None = None, max_files: int | None = None) -> list[StreamingQuery]:
    """Start validation, the catalog and the requested outputs.

    With ``availableNow`` and ``wait``, stages run in order (validation, catalog, then
    the outputs) so that each drains what the previous produced.  ``max_files`` bounds a
    micro-batch of the outputs; the inputs bring their own bounds.
    """
    prepare(spark)
    schema = validated_schema(raw_stream)
    started = [start_validation(raw_stream, paths, trigger)]
    if changelog_stream is not None:
        cat_query = start_catalog(changelog_stream, paths, trigger)
        started.append(cat_query)
        if not wait:
            # like a replicated lookup table: the catalog is loaded before counts are
            # enriched, so the first results are not emitted against an empty catalog
            cat_query.processAllAvailable()
    if wait:
        for q in started:
            q.awaitTermination()
    valid = valid_stream(spark, paths, schema, max_files)
    if paths.kafka is not None:
        started.append(start_dlq_to_kafka(spark, paths, schema, trigger, max_files))
    starters = {"skip_rate": start_skip_rate, "top_by_country": start_top,
                "royalties": start_royalties, "fraud_alerts": start_fraud}
    options = {"royalties": {"dedup_ttl": dedup_ttl},
               "fraud_alerts": {"window_minutes": fraud_window_minutes}}
    outs = [starters[k](valid, paths, trigger, **options.get(k, {})) for k in kinds]
    if wait:
        for q in outs:
            q.awaitTermination()
    return started + outs


def output(spark: SparkSession, paths: Paths, kind: str) -> DataFrame:
    """Current state of one keyed output."""
    return read_table(spark, paths.out(kind), C.UPSERT_KEYS[kind])
