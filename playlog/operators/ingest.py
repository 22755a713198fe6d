"""Routing of validated messages (P2, P3, K1 shape) and event time resolution.

Valid and invalid are two complementary filters on the same validated frame
(``reason IS NULL`` / ``IS NOT NULL``): every message lands in exactly one branch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlog.functions.jsonparse import to_json_text
from playlog.functions.validation import EVENT_COLUMNS, validate
from playlog.operators.windows import running_max

# Ingestion metadata kept with the valid events (needed by the late-data rule).
META_COLUMNS = ("partition", "offset")


def valid_events(validated: DataFrame, keep: tuple[str, ...] = META_COLUMNS) -> DataFrame:
    """P2 + P3: the valid branch, unwrapped to the flat event columns."""
    extra = [c for c in keep if c in validated.columns]
    return validated.filter(F.col("reason").isNull()).select(*extra, *EVENT_COLUMNS)


def invalid_messages(validated: DataFrame) -> DataFrame:
    """The dead-letter branch: original text, reason and the DLQ JSON value (K1)."""
    meta = [c for c in ("partition", "offset") if c in validated.columns]
    return (validated.filter(F.col("reason").isNotNull())
            .select(*meta, "key", F.col("value").alias("original"), "reason",
                    to_json_text(F.col("value").alias("original"), "reason").alias("dlq_value")))


def split(raw: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(valid events, dead letters) as two branches of one validated frame.

    Each branch is its own plan; to parse the input once for both, stage the
    validated table first (``playlog.plans.batch``) or stream it (``streaming.jobs``).
    """
    v = validate(raw, value_col)
    return valid_events(v), invalid_messages(v)


def resolve_event_time(validated: DataFrame, broker_ms: Column | None = None,
                       partition_col: str = "partition", order_col: str = "offset",
                       block_rows: int = 1 << 20) -> DataFrame:
    """The timestamp each message is windowed by, in epoch milliseconds.

    payload instant if it parses; else the broker time if not negative; else the
    largest time resolved so far on the same partition; else 0.  "So far" is the
    prefix maximum over ingestion order, computed in bounded blocks (see
    ``running_max``), never in one task per partition.
    """
    if broker_ms is None:
        broker_ms = F.unix_millis(F.col("broker_time"))
    base = F.coalesce(F.col("event_time_ms"), F.when(broker_ms >= 0, broker_ms))
    staged = validated.withColumn("_base_ms", base)
    with_prev = running_max(staged, "_base_ms", [partition_col], order_col,
                            out_col="_partition_time", inclusive=False, block_rows=block_rows)
    resolved = F.coalesce(F.col("_base_ms"),
                          F.when(F.col("_partition_time") >= 0, F.col("_partition_time")),
                          F.lit(0).cast("bigint"))
    source = (F.when(F.col("event_time_ms").isNotNull(), F.lit("payload"))
              .when(broker_ms >= 0, F.lit("broker"))
              .when(F.col("_partition_time") >= 0, F.lit("partition_time"))
              .otherwise(F.lit("zero")))
    return (with_prev.withColumn("resolved_time_ms", resolved)
            .withColumn("time_source", source)
            .drop("_base_ms", "_partition_time"))
