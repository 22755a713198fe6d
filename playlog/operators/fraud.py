"""Stream-farm alerts: more than N COMPLETE per (user, track) in a tumbling window
(F4, W3, A4, F5).  The pair is kept as two columns, never as a ``user|track`` text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlog import contract as C
from playlog.operators.windows import window_bounds, windowed_groups


def complete_counts(valid: DataFrame, window_minutes: int = C.FRAUD_WINDOW_MINUTES,
                    grace: str | None = None, domain_cols: Sequence[str] = ("partition",),
                    order_col: str = "offset") -> DataFrame:
    """A4: (user_id, track_id, window, count) over COMPLETE events."""
    completed = valid.filter(F.col("event_type") == "COMPLETE")                   # F4
    grouped = windowed_groups(completed, ["user_id", "track_id"], "event_time",
                              f"{int(window_minutes)} minutes", None, grace, domain_cols, order_col)
    return grouped.agg(F.count(F.lit(1)).alias("count"))


def fraud_alerts(valid: DataFrame, window_minutes: int = C.FRAUD_WINDOW_MINUTES,
                 threshold: int = C.FRAUD_THRESHOLD, grace: str | None = None,
                 domain_cols: Sequence[str] = ("partition",), order_col: str = "offset"
                 ) -> DataFrame:
    """Rows: user_id, track_id, count, window_start, window_end, for count > threshold."""
    counts = complete_counts(valid, window_minutes, grace, domain_cols, order_col)
    return (counts.filter(F.col("count") > threshold)                              # F5
                  .select("user_id", "track_id", "count", *window_bounds()))
