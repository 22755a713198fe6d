"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the whole
of the driver's tables (through the fixture adapter), never a subset.

Outputs carry no TIMESTAMP columns: instants are ISO text (as the reference publishes
them) or epoch milliseconds, so results compare the same in any client time zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlog import contract as C
from playlog.functions.validation import validate
from playlog.operators import catalog, fraud, ingest, royalties, skip_rate, top_country
from playlog.session import prepare, scratch_path, staged
from playlog.sources import fixtures
from playlog.streaming.sinks import publish

VALID_OUT = ("partition", "offset", "event_id", "user_id", "track_id", "artist", "event_type",
             "ms_played", "country", "timestamp", "event_time_ms")

# Shorter graces for the late-rule queries, so that the fixture's 90-minute-late
# events are dropped (the reference's own 3 h grace keeps them).
LATE_GRACE_SKIP = "1 hour"
LATE_GRACE_TOP = "1 hour"


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return fixtures.raw_messages(spark, sf_dir)


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(raw(spark, sf_dir))


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.valid_events(validated(spark, sf_dir))


def valid_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The valid events as a staged table: the late rule reads them twice (block maxima and
    the rows themselves), the messages are parsed once."""
    return staged(valid(spark, sf_dir), "valid")


def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return fixtures.catalog_changelog(spark, sf_dir)


def catalog_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.lookup(changelog(spark, sf_dir))


# ---- ingestion ----------------------------------------------------------------------
def validated_events(spark, sf_dir):
    return valid(spark, sf_dir).select(*VALID_OUT)


def dlq_messages(spark, sf_dir):
    return ingest.invalid_messages(validated(spark, sf_dir))


def dlq_reason_counts(spark, sf_dir):
    dlq = ingest.invalid_messages(validated(spark, sf_dir))
    return dlq.groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))


def ingest_totals(spark, sf_dir):
    v = validated(spark, sf_dir)
    return v.agg(F.count(F.lit(1)).alias("messages"),
                 F.count_if(F.col("reason").isNull()).alias("valid"),
                 F.count_if(F.col("reason").isNotNull()).alias("dead_letters"))


def event_time_resolved(spark, sf_dir):
    times = validated(spark, sf_dir).select("partition", "offset", "broker_time", "event_time_ms")
    r = ingest.resolve_event_time(staged(times, "event-times"))
    return r.select("partition", "offset", "resolved_time_ms", "time_source")


# ---- skip rate ----------------------------------------------------------------------
def skip_rate_q(spark, sf_dir):
    return skip_rate.skip_rate(valid(spark, sf_dir))


def flops_q(spark, sf_dir):
    return skip_rate.flops(valid(spark, sf_dir))


def late_filtered_skip_rate(spark, sf_dir):
    return skip_rate.skip_rate(valid_once(spark, sf_dir), grace=LATE_GRACE_SKIP)


# ---- top by country -----------------------------------------------------------------
def catalog_latest_q(spark, sf_dir):
    return catalog.latest(changelog(spark, sf_dir))


def catalog_rejected_q(spark, sf_dir):
    return catalog.rejected(changelog(spark, sf_dir))


def top_by_country_q(spark, sf_dir):
    return top_country.top_by_country(valid(spark, sf_dir), catalog_side(spark, sf_dir))


def top_unknown_tracks(spark, sf_dir):
    return top_country.unknown_tracks(top_by_country_q(spark, sf_dir))


def late_filtered_top(spark, sf_dir):
    return top_country.top_by_country(valid_once(spark, sf_dir), catalog_side(spark, sf_dir),
                                      grace=LATE_GRACE_TOP)


# ---- royalties ----------------------------------------------------------------------
def royalties_q(spark, sf_dir):
    return royalties.royalties(valid(spark, sf_dir))


def royalty_eligible_dedup(spark, sf_dir):
    return royalties.paid_events(valid(spark, sf_dir))


# ---- fraud --------------------------------------------------------------------------
def fraud_alerts_q(spark, sf_dir):
    return fraud.fraud_alerts(valid(spark, sf_dir))


def fraud_alerts_hourly(spark, sf_dir):
    return fraud.fraud_alerts(valid(spark, sf_dir), window_minutes=60)


def late_filtered_fraud(spark, sf_dir):
    return fraud.fraud_alerts(valid_once(spark, sf_dir), grace=C.FRAUD_GRACE)


# ---- published records and the whole job ---------------------------------------------
def _published(frames: dict[str, DataFrame]) -> DataFrame:
    """topic, key, value of several keyed outputs as the contract publishes them."""
    out = None
    for kind, df in frames.items():
        rows = publish(df, kind).select(F.lit(C.output_name(kind)).alias("topic"), "key", "value")
        out = rows if out is None else out.unionByName(rows)
    return out


def published_records(spark, sf_dir):
    """Keys joined by |, values as JSON, alerts with their own field names."""
    v = valid_once(spark, sf_dir)
    return _published({
        "skip_rate": skip_rate.skip_rate(v), "royalties": royalties.royalties(v),
        "top_by_country": top_country.top_by_country(v, catalog_side(spark, sf_dir)),
        "fraud_alerts": fraud.fraud_alerts(v)})


def batch_job_outputs(spark, sf_dir):
    """One run of the whole batch job; its five written outputs as published."""
    from playlog.plans import batch

    written = batch.run(spark, raw(spark, sf_dir), changelog(spark, sf_dir),
                        scratch_path(spark, "batch_job_outputs"))
    kinds = {C.output_name(k): k for k in C.OUTPUT_SUFFIXES}
    tables = {kinds[name]: spark.read.parquet(path) for name, path in written.items()}
    dead = tables.pop("dlq").select(F.lit(C.output_name("dlq")).alias("topic"), "key",
                                    F.col("dlq_value").alias("value"))
    return _published(tables).unionByName(dead)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from playlog.plans import replay_queries, stream_queries
    reg = {
        "validated_events": validated_events,
        "dlq_messages": dlq_messages,
        "dlq_reason_counts": dlq_reason_counts,
        "ingest_totals": ingest_totals,
        "event_time_resolved": event_time_resolved,
        "skip_rate": skip_rate_q,
        "flops": flops_q,
        "late_filtered_skip_rate": late_filtered_skip_rate,
        "catalog_latest": catalog_latest_q,
        "catalog_rejected": catalog_rejected_q,
        "top_by_country": top_by_country_q,
        "top_unknown_tracks": top_unknown_tracks,
        "late_filtered_top": late_filtered_top,
        "royalties": royalties_q,
        "royalty_eligible_dedup": royalty_eligible_dedup,
        "fraud_alerts": fraud_alerts_q,
        "fraud_alerts_hourly": fraud_alerts_hourly,
        "late_filtered_fraud": late_filtered_fraud,
        "published_records": published_records,
        "batch_job_outputs": batch_job_outputs,
    }
    reg.update(replay_queries.registry())
    reg.update(stream_queries.registry())
    return reg
