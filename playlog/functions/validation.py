"""Listening-event validation (P1, C3-C7, V1-V10) in one map-only pass.

``validate(raw)`` adds the typed event fields, the event time and ``reason``: NULL when
the message is valid, else the text of the first rule that fails.  One ``from_json``
per message, a few projections and a fence (see ``jsonparse.fence``); no Python in the
hot path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlog import contract as C
from playlog.functions.jsonparse import fence, parse_record
from playlog.functions.timefmt import epoch_millis, parse_iso_instant

TEXT_FIELDS = ("event_id", "user_id", "track_id", "artist", "event_type", "country", "timestamp")
EVENT_FIELDS = ("event_id", "user_id", "track_id", "artist", "event_type", "ms_played",
                "country", "timestamp")
EVENT_COLUMNS = EVENT_FIELDS + ("event_time", "event_time_ms")


# FIXED VALUES: the characters Java's Character.isWhitespace accepts (String.isBlank).
JAVA_WHITESPACE = ("\t\n\u000b\f\r\u001c\u001d\u001e\u001f "
                   "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
                   "\u2008\u2009\u200a\u2028\u2029\u205f\u3000")


def is_blank(c: Column) -> Column:
    """Null, empty or only Unicode white space (Java ``isBlank``)."""
    return c.isNull() | (F.btrim(c, F.lit(JAVA_WHITESPACE)) == "")


def _text_or_null(c: Column) -> Column:
    return F.coalesce(c, F.lit("null"))


def reason_of(f: dict[str, Column], unreadable: Column, event_time: Column) -> Column:
    """The first failing rule's text, NULL when all pass."""
    et, ms, country, ts = f["event_type"], f["ms_played"], f["country"], f["timestamp"]
    return F.coalesce(
        F.when(unreadable, F.lit(C.REASON_BAD_JSON)),
        F.when(is_blank(f["event_id"]), F.lit(C.REASON_NO_EVENT_ID)),
        F.when(is_blank(f["user_id"]), F.lit(C.REASON_NO_USER_ID)),
        F.when(is_blank(f["track_id"]), F.lit(C.REASON_NO_TRACK_ID)),
        F.when(is_blank(f["artist"]), F.lit(C.REASON_NO_ARTIST)),
        F.when(~F.coalesce(et.isin(*C.EVENT_TYPES), F.lit(False)),
               F.concat(F.lit(C.REASON_BAD_EVENT_TYPE), _text_or_null(et))),
        F.when(~F.coalesce(ms >= 0, F.lit(False)),
               F.concat(F.lit(C.REASON_BAD_MS_PLAYED), _text_or_null(ms.cast("string")))),
        F.when(~F.coalesce(country.isin(*C.COUNTRIES), F.lit(False)),
               F.concat(F.lit(C.REASON_BAD_COUNTRY), _text_or_null(country))),
        F.when(ts.isNull(), F.lit(C.REASON_NO_TIMESTAMP)),
        F.when(event_time.isNull(), F.concat(F.lit(C.REASON_BAD_TIMESTAMP), ts)),
    )


def validate(raw: DataFrame, value_col: str = "value", where: Column | str | None = None,
             keep: Sequence[str] | None = None) -> DataFrame:
    """Keep the input columns, add the event columns and ``reason``.

    ``where`` (a condition on input columns) and ``keep`` (the input columns to carry; all
    by default) apply before the parse, so they reach the source as partition filters,
    pushed filters and a pruned read schema.  Behind the parse nothing is pushed back.

    Works on batch and streaming frames alike.  ``event_time`` is the payload instant
    (TIMESTAMP, UTC) when the message is readable and its timestamp parses, whatever
    the other rules say (it is what the event-time rule W4 uses).
    """
    if where is not None:
        raw = raw.where(where)
    carried = list(raw.columns if keep is None else keep)
    raw = raw.select(*dict.fromkeys([*carried, value_col]))
    parsed = parse_record(raw, value_col, TEXT_FIELDS, ("ms_played",))
    timed = parsed.withColumn(
        "event_time", F.when(~F.col("_unreadable"), parse_iso_instant(F.col("timestamp"))))
    reason = reason_of({n: F.col(n) for n in EVENT_FIELDS}, F.col("_unreadable"),
                       F.col("event_time"))
    return fence(timed.select(*[F.col(c) for c in carried],
                              *[F.col(n) for n in EVENT_FIELDS], "event_time",
                              epoch_millis(F.col("event_time")).alias("event_time_ms"),
                              reason.alias("reason")))
