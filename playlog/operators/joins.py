"""Broadcast only behind a proven size bound.

``size_bound`` computes, with one cheap aggregate over the *input* of a small table
(e.g. the catalog changelog), an upper bound of the table's in-memory size: every
kept row is one input row, every kept field a piece of its text.  ``bounded_broadcast``
hints a broadcast only when that bound is under the limit; beyond it the join is hinted
as a sort-merge join, which works at any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Per-row allowance for the UnsafeRow header, null bits, offsets and hash-map slot.
ROW_OVERHEAD_BYTES = 96
DEFAULT_LIMIT_BYTES = 64 << 20


def size_bound(source: DataFrame, *text_cols: str) -> int:
    """Upper bound, in bytes, of any table derived row-for-row from ``source``'s text."""
    lengths = [F.coalesce(F.octet_length(c), F.lit(0)) for c in text_cols] or [F.lit(0)]
    row = sum(lengths[1:], lengths[0]) + F.lit(ROW_OVERHEAD_BYTES)
    got = source.agg(F.sum(row.cast("bigint")).alias("b")).first()
    return int(got["b"] or 0)


def broadcast_limit(df: DataFrame) -> int:
    conf = df.sparkSession.conf.get("spark.playlog.broadcastLimitBytes", None)
    return int(conf) if conf else DEFAULT_LIMIT_BYTES


def bounded_broadcast(small: DataFrame, bound_bytes: int, limit_bytes: int | None = None
                      ) -> DataFrame:
    """``broadcast(small)`` if its proven bound fits, else a sort-merge join hint (so an
    optimistic size estimate cannot broadcast an unbounded side either)."""
    limit = broadcast_limit(small) if limit_bytes is None else limit_bytes
    return F.broadcast(small) if bound_bytes <= limit else small.hint("merge")
