"""Track catalog from a compacted changelog (S2) and its lookup side for J1.

A compacted topic read as a table: the last value per key wins and a null value
deletes the key.  A value that cannot be read as a track is set aside (as a
log-and-continue deserialisation handler would), so the key keeps its previous state.
``latest`` is one partial + final sort aggregate (``max_by`` over the ingestion
position), so a key rewritten a billion times is still pre-aggregated map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlog.functions.jsonparse import fence, parse_record
from playlog.operators.joins import bounded_broadcast, size_bound

TRACK_TEXT_FIELDS = ("track_id", "title", "artist", "genre")
TRACK_FIELDS = TRACK_TEXT_FIELDS + ("duration_ms",)


def parse_tracks(changelog: DataFrame, value_col: str = "value") -> DataFrame:
    """Adds the typed track fields and ``readable`` (tombstones are not readable)."""
    parsed = parse_record(changelog, value_col, TRACK_TEXT_FIELDS, ("duration_ms",))
    return fence(parsed.withColumn("readable", ~F.col("_unreadable")).drop("_unreadable"))


def latest(changelog: DataFrame, key_col: str = "key",
           order_cols: Sequence[str] = ("partition", "offset"), value_col: str = "value"
           ) -> DataFrame:
    """Current catalog, one row per live key: key + track fields."""
    tracks = parse_tracks(changelog, value_col)
    usable = tracks.filter(F.col(value_col).isNull() | F.col("readable"))
    state = F.struct(F.col(value_col).isNull().alias("deleted"), *[F.col(f) for f in TRACK_FIELDS])
    position = F.struct(*[F.col(c) for c in order_cols])
    current = usable.groupBy(key_col).agg(F.max_by(state, position).alias("s"))
    return (current.filter(~F.col("s.deleted"))
                   .select(key_col, *[F.col(f"s.{f}").alias(f) for f in TRACK_FIELDS]))


def rejected(changelog: DataFrame, value_col: str = "value") -> DataFrame:
    """Catalog records set aside because their value is not a readable track."""
    tracks = parse_tracks(changelog, value_col)
    return tracks.filter(F.col(value_col).isNotNull() & ~F.col("readable")).select(*changelog.columns)


def lookup(changelog: DataFrame, key_col: str = "key", limit_bytes: int | None = None,
           order_cols: Sequence[str] = ("partition", "offset")) -> DataFrame:
    """J1's right side: (track key, title, artist, genre, presence marker).

    Broadcast only when the changelog's text (an upper bound of the current catalog)
    fits under the limit; otherwise it is hinted as a sort-merge join.
    """
    current = latest(changelog, key_col, order_cols)
    side = current.select(F.col(key_col).alias("_track_key"), "title", "artist", "genre",
                          F.lit(True).alias("_in_catalog"))
    bound = size_bound(changelog, key_col, "value")
    return bounded_broadcast(side, bound, limit_bytes)
