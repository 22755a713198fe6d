"""Listen counts per country and track in hopping windows, enriched from the catalog
(F2, W2, A3, J1).

Count first, join after: one catalog lookup per result row, not per event, and the
aggregate state carries no catalog text.  The join is a left join, so an uncatalogued
or deleted track keeps its count with null title / artist / genre and
``enriched = false``; ``enriched`` tests the presence of the catalog row, not its title.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlog import contract as C
from playlog.operators.windows import window_bounds, windowed_groups


def listen_counts(valid: DataFrame, size: str = C.TOP_WINDOW, slide: str = C.TOP_SLIDE,
                  grace: str | None = None, domain_cols: Sequence[str] = ("partition",),
                  order_col: str = "offset") -> DataFrame:
    """A3: (country, track_id, window, listens) over non-START events."""
    played = valid.filter(F.col("event_type") != "START")                        # F2
    grouped = windowed_groups(played, ["country", "track_id"], "event_time", size, slide, grace,
                              domain_cols, order_col)
    return grouped.agg(F.count(F.lit(1)).alias("listens"))


def enrich(counts: DataFrame, catalog_side: DataFrame) -> DataFrame:
    """Left join of counted windows with the catalog lookup side."""
    j = counts.join(catalog_side, counts["track_id"] == catalog_side["_track_key"], "left")
    return j.select("country", "track_id", "title", "artist", "genre", *window_bounds(),
                    "listens", F.col("_in_catalog").isNotNull().alias("enriched"))


def top_by_country(valid: DataFrame, catalog_side: DataFrame, size: str = C.TOP_WINDOW,
                   slide: str = C.TOP_SLIDE, grace: str | None = None,
                   domain_cols: Sequence[str] = ("partition",), order_col: str = "offset"
                   ) -> DataFrame:
    """Rows: country, track_id, title, artist, genre, window_start, window_end, listens,
    enriched."""
    return enrich(listen_counts(valid, size, slide, grace, domain_cols, order_col), catalog_side)


def unknown_tracks(top: DataFrame) -> DataFrame:
    """Rows that found no catalog entry."""
    return top.filter(~F.col("enriched"))
