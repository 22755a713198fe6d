"""Registered streaming queries: the driver's ``events`` (and ``part``) tables read as
file streams, run through the streaming jobs with ``availableNow`` into upsert tables
under the shared checkpoint folder, and returned as the tables' current state.

Each file is one micro-batch here, so no event is dropped by the watermark and the
final tables equal the batch results (the oracle is the batch SQL).  Late drops over
several micro-batches are covered by tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlog.session import prepare, scratch_path
from playlog.sources import fixtures
from playlog.streaming import exact, jobs


def _catalog_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (fixtures.part_stream(spark, sf_dir).selectExpr(*fixtures.SPARK_CAT_VERSIONS)
                .selectExpr(*fixtures.quoted(fixtures.CAT_BODY, "`")))


def _run(spark: SparkSession, sf_dir: str, name: str, kinds, with_catalog: bool = False
         ) -> jobs.Paths:
    prepare(spark)
    paths = jobs.Paths(scratch_path(spark, name))
    raw = fixtures.raw_messages_from(fixtures.events_stream(spark, sf_dir))
    changelog = _catalog_stream(spark, sf_dir) if with_catalog else None
    # state partitions sized to this session's task slots (a cluster picks its own)
    trigger = jobs.Trigger(state_partitions=2 * spark.sparkContext.defaultParallelism)
    jobs.run(spark, raw, paths, changelog, trigger=trigger, kinds=kinds)
    return paths


def stream_skip_rate(spark, sf_dir):
    return jobs.output(spark, _run(spark, sf_dir, "stream_skip_rate", ["skip_rate"]), "skip_rate")


def stream_top(spark, sf_dir):
    paths = _run(spark, sf_dir, "stream_top", ["top_by_country"], with_catalog=True)
    return jobs.output(spark, paths, "top_by_country")


def stream_royalties(spark, sf_dir):
    return jobs.output(spark, _run(spark, sf_dir, "stream_royalties", ["royalties"]), "royalties")


def stream_fraud(spark, sf_dir):
    return jobs.output(spark, _run(spark, sf_dir, "stream_fraud", ["fraud_alerts"]), "fraud_alerts")


def stream_dlq(spark, sf_dir):
    return jobs.dead_letters(spark, _run(spark, sf_dir, "stream_dlq", []))


def stream_catalog(spark, sf_dir):
    paths = _run(spark, sf_dir, "stream_catalog", [], with_catalog=True)
    return jobs.current_catalog(spark, paths)


# ---- several micro-batches -----------------------------------------------------------
BATCHES = 6
FILES_PER_BATCH = 4
BATCH_GRACE = "30 minutes"
EXACT_GRACE = "1 hour"   # that of late_filtered_skip_rate


def _valid_in_batches(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The valid events as a stream of BATCHES micro-batches in ingestion order: written in
    that order, FILES_PER_BATCH files each, and read back that many at a time."""
    from playlog.plans.queries import valid_once

    v = valid_once(spark, sf_dir).withColumn("_seq", F.expr("`offset` DIV 2"))
    end = v.agg(F.max("_seq") + 1).first()[0]
    path = scratch_path(spark, name, "batches")
    for b in range(BATCHES):
        (v.where(F.expr(f"_seq * {BATCHES} DIV {end} = {b}")).drop("_seq")
         .repartition(FILES_PER_BATCH).write.mode("append").parquet(path))
    return (spark.readStream.schema(v.drop("_seq").schema)
            .option("maxFilesPerTrigger", FILES_PER_BATCH).parquet(path))


def _batched(spark: SparkSession, sf_dir: str, name: str, start, kind: str, **options) -> DataFrame:
    prepare(spark)
    paths = jobs.Paths(scratch_path(spark, name))
    trigger = jobs.Trigger(state_partitions=2 * spark.sparkContext.defaultParallelism)
    start(_valid_in_batches(spark, sf_dir, name), paths, trigger, **options).awaitTermination()
    return jobs.output(spark, paths, kind)


def stream_skip_rate_batches(spark, sf_dir):
    """Rows beyond the watermark are dropped: that of two micro-batches before."""
    return _batched(spark, sf_dir, "stream_skip_rate_batches", jobs.start_skip_rate, "skip_rate",
                    grace=BATCH_GRACE)


def stream_royalties_batches(spark, sf_dir):
    """Duplicates are recognised across micro-batches."""
    return _batched(spark, sf_dir, "stream_royalties_batches", jobs.start_royalties, "royalties")


def stream_late_exact(spark, sf_dir):
    """The per-record late rule over several micro-batches, each source partition with its own
    stream time."""
    prepare(spark)
    paths = jobs.Paths(scratch_path(spark, "stream_late_exact"))
    trigger = jobs.Trigger(state_partitions=2 * spark.sparkContext.defaultParallelism)
    for q in exact.start_skip_rate(_valid_in_batches(spark, sf_dir, "stream_late_exact"), paths,
                                   trigger, grace=EXACT_GRACE):
        q.awaitTermination()
    return jobs.output(spark, paths, "skip_rate")


def registry():
    return {"stream_late_exact": stream_late_exact,
            "stream_skip_rate_batches": stream_skip_rate_batches,
            "stream_royalties_batches": stream_royalties_batches,
            "stream_skip_rate": stream_skip_rate, "stream_top": stream_top,
            "stream_royalties": stream_royalties, "stream_fraud": stream_fraud,
            "stream_dlq": stream_dlq, "stream_catalog": stream_catalog}
