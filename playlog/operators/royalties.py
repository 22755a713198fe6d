"""Royalties per artist, each eligible event paid once.

Eligible: COMPLETE with ``ms_played >= 30000``.  De-duplication is by event_id within
the artist (one id under two artists pays each of them).  Batch plan: a hash aggregate
on (artist, event_id) — which spreads a hot artist over every reducer — then a partial
count per artist; money is exact DECIMAL, not a floating-point sum.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlog import contract as C


def eligible(valid: DataFrame, min_ms: int = C.MIN_MS_FOR_ROYALTY) -> DataFrame:
    """F3."""
    return valid.filter((F.col("event_type") == "COMPLETE") & (F.col("ms_played") >= min_ms))


def paid_events(valid: DataFrame, min_ms: int = C.MIN_MS_FOR_ROYALTY) -> DataFrame:
    """One row per (artist, event_id) that earns a payment."""
    return eligible(valid, min_ms).select("artist", "event_id").dropDuplicates(["artist", "event_id"])


def money(paid_streams, rate: Decimal = C.ROYALTY_PER_STREAM):
    return (paid_streams * F.lit(rate)).cast(C.MONEY_TYPE)


def royalties(valid: DataFrame, rate: Decimal = C.ROYALTY_PER_STREAM,
              min_ms: int = C.MIN_MS_FOR_ROYALTY) -> DataFrame:
    """A5 rows: artist, paid_streams, total (DECIMAL(18,3))."""
    per_artist = paid_events(valid, min_ms).groupBy("artist").agg(
        F.count(F.lit(1)).alias("paid_streams"))
    return per_artist.select("artist", "paid_streams", money(F.col("paid_streams"), rate).alias("total"))
