"""Skip rate per track in tumbling windows, with flop detection.

One aggregate with two conditional counters (partial + final hash aggregation, so a
hot track is pre-aggregated on the map side and never lands whole in one task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from playlog import contract as C
from playlog.operators.windows import window_bounds, windowed_groups


def skip_counters(valid: DataFrame, window: str = C.SKIP_WINDOW, grace: str | None = None,
                  domain_cols: Sequence[str] = ("partition",), order_col: str = "offset",
                  time_col: str = "event_time") -> DataFrame:
    """A1: (track_id, window, skips, completes) over SKIP / COMPLETE events."""
    listened = valid.filter(F.col("event_type").isin("SKIP", "COMPLETE"))       # F1
    grouped = windowed_groups(listened, ["track_id"], time_col, window, None, grace,
                              domain_cols, order_col)
    return counters(grouped)


def counters(grouped: GroupedData) -> DataFrame:
    """The two counters of each group."""
    return grouped.agg(
        F.count_if(F.col("event_type") == "SKIP").cast("int").alias("skips"),
        F.count_if(F.col("event_type") != "SKIP").cast("int").alias("completes"))


def rate_columns(flop_rate: float = C.FLOP_RATE, flop_min: int = C.FLOP_MIN_LISTENS):
    """A2 + F6 on (skips, completes)."""
    total = F.col("skips") + F.col("completes")
    rate = F.when(total == 0, F.lit(0.0)).otherwise(F.col("skips") / total)
    return [total.alias("total"), rate.alias("skip_rate"),
            ((rate > F.lit(float(flop_rate))) & (total >= flop_min)).alias("flop")]


def skip_rate(valid: DataFrame, window: str = C.SKIP_WINDOW, grace: str | None = None,
              flop_rate: float = C.FLOP_RATE, flop_min: int = C.FLOP_MIN_LISTENS,
              domain_cols: Sequence[str] = ("partition",), order_col: str = "offset") -> DataFrame:
    """Skip-rate rows: track_id, window_start, window_end, skips, completes, total,
    skip_rate, flop.  ``grace`` applies the batch late-data rule (None: every event)."""
    counted = skip_counters(valid, window, grace, domain_cols, order_col)
    return counted.select("track_id", *window_bounds(), "skips", "completes",
                           *rate_columns(flop_rate, flop_min))


def flops(valid: DataFrame, **kw) -> DataFrame:
    """the flagged windows only."""
    return skip_rate(valid, **kw).filter(F.col("flop"))
