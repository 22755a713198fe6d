"""Instants: strict ISO-8601 parse (C6), ISO text of window bounds (C10), epoch ms.

``parse_iso_instant`` accepts what an ISO instant parser accepts: date, ``T``, hours,
minutes, seconds, an optional fraction of up to nine digits and ``Z`` or an offset of
hours and minutes (seconds optional), letters in either case.  ``24:00:00`` means the next midnight and
``23:59:60`` (leap second) reads as ``23:59:59``.  Everything else gives NULL.
Spark's own cast alone is looser (date only, a blank for ``T``, no zone), hence the
pattern guard in front of it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_INSTANT_RE = (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{0,9})?"
                  r"(Z|[+-][0-9]{2}:[0-9]{2}(:[0-9]{2})?)$")
_END_OF_DAY_RE = r"T24:00:00(\.0{0,9})?(?=[Z+-])"
_LEAP_SECOND_RE = r"T23:59:60"

ISO_TEXT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def parse_iso_instant(text: Column) -> Column:
    """TIMESTAMP of a strict ISO-8601 instant, NULL when the text is not one.

    One pattern match and one cast per row; the rare ``24:00:00`` / ``23:59:60`` forms
    take a separate branch that is only evaluated for them.
    """
    u = F.upper(text)
    special = u.contains("T24:00:00") | u.contains("T23:59:60")
    norm = F.regexp_replace(F.regexp_replace(u, _END_OF_DAY_RE, "T00:00:00"),
                            _LEAP_SECOND_RE, "T23:59:59").try_cast("timestamp")
    special_ts = F.when(u.rlike(_END_OF_DAY_RE), norm + F.expr("INTERVAL 1 DAY")).otherwise(norm)
    return F.when(u.rlike(ISO_INSTANT_RE),
                  F.when(special, special_ts).otherwise(u.try_cast("timestamp")))


def iso_text(ts: Column) -> Column:
    """Window bound as ISO text, whole seconds, UTC (session zone is pinned to UTC)."""
    return F.date_format(ts, ISO_TEXT_FORMAT)


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts)
