"""Time windows (W1-W3, W7), window text (P8/C10) and the late-data rule.

Windows are Spark's own ``window()``: tumbling and hopping windows aligned to the epoch
in UTC, half-open ``[start, end)``.  A hopping window of size ``s`` and slide ``d``
puts each event in ``s / d`` windows (an ``Expand`` ahead of the partial aggregate,
so the fan-out never crosses a shuffle).

The late-data rule of a windowed aggregate: an event updates one of its windows only
if ``window_end > stream_time - grace``, where stream time is the largest event time
seen so far (this event included) in the same stream-time domain, in ingestion order.
Streaming jobs get this from ``withWatermark``, or exactly from ``streaming.exact``; in
batch, ``late_windows`` decides it from the ingestion order: a window closes at the first
record whose event time is at least its end plus the grace, so one small table of closing
positions (``closings``) decides every event without sorting or shuffling the events.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlog.functions.timefmt import iso_text
from playlog.operators.joins import ROW_OVERHEAD_BYTES, broadcast_limit
from playlog.session import staged


def window_of(time_col: str, size: str, slide: str | None = None) -> Column:
    """Tumbling (``slide`` None) or hopping window struct of ``time_col``."""
    return F.window(time_col, size, slide) if slide else F.window(time_col, size)


def window_bounds(window_col: str = "window") -> list[Column]:
    """The window as ISO text bounds ``window_start`` / ``window_end``."""
    return [iso_text(F.col(f"{window_col}.start")).alias("window_start"),
            iso_text(F.col(f"{window_col}.end")).alias("window_end")]


#: Blocks that one window task of a prefix maximum may hold.
FAN = 1 << 22


def _before(blocks: DataFrame, parts: list[str], n: int, levels: int, fan: int) -> DataFrame:
    """The maxima ``_p0``.. of the blocks before each block ``_blk`` of (parts, _blk, _b0..).

    With ``levels`` above, a window covers the at most ``fan`` blocks of one group, and the
    groups before it come from the same rule one level up, joined on (parts, group).
    """
    past = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)

    def within(*keys):
        return [F.max(f"_b{i}").over(past.partitionBy(*keys)).alias(f"_w{i}") for i in range(n)]

    if not levels:
        return blocks.select(*parts, "_blk", *within(*parts)).toDF(
            *parts, "_blk", *[f"_p{i}" for i in range(n)])
    grouped = blocks.withColumn("_up", F.expr(f"_blk div {fan}"))
    ups = grouped.groupBy(*parts, F.col("_up").alias("_blk")).agg(
        *[F.max(f"_b{i}").alias(f"_b{i}") for i in range(n)])
    above = _before(ups, parts, n, levels - 1, fan).withColumnRenamed("_blk", "_up")
    inside = grouped.select(*parts, "_blk", "_up", *within(*parts, "_up"))
    return inside.join(above, [*parts, "_up"]).select(
        *parts, "_blk", *[F.greatest(f"_w{i}", f"_p{i}").alias(f"_p{i}") for i in range(n)])


def running_max(df: DataFrame, value_col, partition_cols: Sequence[str], order_col: str,
                out_col="running_max", inclusive: bool = True,
                block_rows: int = 1 << 20, fan: int = FAN, order_bits: int = 63) -> DataFrame:
    """Prefix maximum of ``value_col`` over ``order_col`` within ``partition_cols``.

    ``value_col`` / ``out_col`` may be lists (column names or expressions / names):
    several prefix maxima share one pass.

    A plain ``max() OVER (PARTITION BY p ORDER BY o)`` would put a whole source
    partition (possibly a third of all rows) in one task.  Instead: cut the order into
    blocks of at most ``block_rows`` positions, aggregate one maximum per block (small
    table), take the prefix maximum of previous blocks over that small table, and join it
    back on (partition, block) to a window computed inside each bounded block.  The small
    table's prefix is hierarchical: no window task holds more than ``fan`` blocks, however
    long a partition is (positions are below 2^``order_bits``).  The
    window's exchange and sort also serve the merge join: one shuffle and one sort of
    the big side.  ``inclusive=False`` gives the maximum of strictly earlier rows.
    """
    values = value_col if isinstance(value_col, (list, tuple)) else [value_col]
    outs = out_col if isinstance(out_col, (list, tuple)) else [out_col]
    vals = [F.col(v) if isinstance(v, str) else v for v in values]
    parts = list(partition_cols)
    keys = [*parts, "_blk"]
    staged = df.select("*", F.expr(f"`{order_col}` div {int(block_rows)}").alias("_blk"),
                       *[v.alias(f"_v{i}") for i, v in enumerate(vals)])
    blocks = staged.groupBy(*keys).agg(*[F.max(f"_v{i}").alias(f"_b{i}") for i in range(len(vals))])
    levels = max(1, math.ceil((order_bits - math.log2(block_rows)) / math.log2(fan))) - 1
    prefix = _before(blocks, parts, len(vals), levels, fan)
    inner_end = Window.currentRow if inclusive else -1
    inner = (Window.partitionBy(*keys).orderBy(order_col)
             .rowsBetween(Window.unboundedPreceding, inner_end))
    # The in-block window runs first: its exchange on (partition, block) and its sort on
    # (partition, block, offset) already satisfy the merge join, so the big side is
    # shuffled and sorted once.  Sort-merge join, never a broadcast.
    walked = staged.select("*", *[F.max(f"_v{i}").over(inner).alias(f"_r{i}")
                                  for i in range(len(vals))])
    joined = walked.join(prefix.hint("merge"), keys, "left")
    result = joined.select("*", *[F.greatest(F.col(f"_p{i}"), F.col(f"_r{i}")).alias(o)
                                  for i, o in enumerate(outs)])
    tmp = ["_blk"] + [f"_{x}{i}" for i in range(len(vals)) for x in "vrp"]
    return result.drop(*tmp)


def _micros(interval: str) -> Column:
    """Length of a day-time interval in microseconds (a constant)."""
    return F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {interval}"))


END, CLOSED = "_window_end", "_closed_at"
#: A closing as it lies in a broadcast table: domain, window end, position.
CLOSING_BYTES = 32 + ROW_OVERHEAD_BYTES


def closings(df: DataFrame, time_col: str, size: str, slide: str | None, grace: str,
             domain_cols: Sequence[str], order_col: str) -> DataFrame:
    """(domain, window end in microseconds, position of the record that closes it).

    A record at time t closes every window that ends at or before t - grace, for itself and
    for all that follow it in its domain.  Each record contributes the latest end it
    closes; the windows records fall into are added, so that each has its row.  Both are
    aggregated in the map tasks, and a suffix minimum over the ends, of which a year has
    some 100,000, gives each window its first closing position (null if it stays open).
    """
    step = _micros(slide or size)
    at = F.unix_micros(time_col) - _micros(grace)
    last_end = at - F.pmod(at - _micros(size), step)
    ends = df.select(*domain_cols, F.col(order_col).alias("_o"), last_end.alias(END),
                     F.unix_micros(window_of(time_col, size, slide)["end"]).alias("_own"))
    both = ends.select(*domain_cols, F.inline(F.array(
        F.struct(F.col(END).alias(END), F.col("_o").alias("_o")),
        F.struct(F.col("_own").alias(END), F.lit(None).cast("long").alias("_o")))))
    first = both.groupBy(*domain_cols, END).agg(F.min("_o").alias("_o"))
    later = (Window.partitionBy(*domain_cols).orderBy(F.desc(END))
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return first.select(*domain_cols, END, F.min("_o").over(later).alias(CLOSED))


def interval_bounds(table: DataFrame, domain_cols: Sequence[str], step: int) -> DataFrame:
    """The first and the last closing position of the windows that end within an interval of
    ``step`` microseconds (no last one if a window of it stays open): before the first all
    of them are open, from the last on all are closed."""
    return table.groupBy(*domain_cols, F.expr(f"`{END}` div {step}").alias(END)).agg(
        F.min(CLOSED).alias("_first"),
        F.when(F.count(F.lit(1)) == F.count(CLOSED), F.max(CLOSED)).alias("_last"))


#: The shortest interval of bounds, in microseconds; each try takes eight times more.
INTERVAL = 3_600_000_000


def late_windows(df: DataFrame, time_col: str, size: str, slide: str | None, grace: str,
                 domain_cols: Sequence[str] = ("partition",), order_col: str = "offset",
                 limit_bytes: int | None = None) -> DataFrame:
    """W5 in batch: one row per (event, window) the event may still update.

    ``df`` must hold exactly the records that reach the aggregate (after its filter),
    with their ingestion position ``order_col`` inside the stream-time domain
    ``domain_cols`` (the source partition by default).  It is read twice: for the closing
    positions, which are staged, and for the events.

    An event keeps a window as long as its position lies before the closing position.  While the
    closings fit under the broadcast limit, that is one broadcast join, and no event
    crosses the network before the aggregate's partial counts.  Beyond the limit, bounds
    over longer and longer intervals of window ends are broadcast instead; they decide
    all events but those between an interval's first and last closing, and only these
    are shuffled to the exact table.
    """
    table = staged(closings(df, time_col, size, slide, grace, domain_cols, order_col), "closings")
    closed = table.where(F.col(CLOSED).isNotNull())
    limit = (broadcast_limit(df) if limit_bytes is None else limit_bytes) // CLOSING_BYTES
    windows = df.select("*", window_of(time_col, size, slide).alias("window"))
    end, at = F.unix_micros(F.col("window.end")), F.col(order_col)

    def joined(rows: DataFrame, side: DataFrame, key: Column) -> DataFrame:
        names = {c: f"_d{i}" for i, c in enumerate(domain_cols)} | {END: "_key"}
        on = [F.col(c).eqNullSafe(F.col(names[c])) for c in domain_cols] + [key == F.col("_key")]
        return rows.join(side.withColumnsRenamed(names), on, "left").drop(*names.values())

    def judged(rows: DataFrame, side: DataFrame) -> DataFrame:
        found = joined(rows, side, end)
        return found.where(F.col(CLOSED).isNull() | (at < F.col(CLOSED))).drop(CLOSED)

    if closed.count() <= limit:
        return judged(windows, F.broadcast(closed))
    step = INTERVAL
    bounds = staged(interval_bounds(table, domain_cols, step), "closing-bounds")
    while bounds.count() > limit and step < 1 << 62:
        step *= 8
        bounds = staged(interval_bounds(table, domain_cols, step), "closing-bounds")
    near = joined(windows, F.broadcast(bounds), F.expr(f"unix_micros(window.end) div {step}"))
    first, last = F.col("_first"), F.col("_last")
    still_open = near.where(first.isNull() | (at < first)).drop("_first", "_last")
    between = near.where((at >= first) & (last.isNull() | (at < last))).drop("_first", "_last")
    return still_open.unionByName(judged(between, closed.hint("merge")))


def windowed_groups(df: DataFrame, keys: Sequence[str], time_col: str, size: str,
                    slide: str | None = None, grace: str | None = None,
                    domain_cols: Sequence[str] = ("partition",), order_col: str = "offset"):
    """``groupBy(keys, window)``, with the batch late-data rule when ``grace`` is given."""
    if grace is None:
        return df.groupBy(*keys, window_of(time_col, size, slide).alias("window"))
    late = late_windows(df, time_col, size, slide, grace, domain_cols, order_col)
    return late.groupBy(*keys, "window")
