"""Fixed values of the data contract.

FIXED VALUES: these must equal the reference's for equal results (enumerations,
reason texts, thresholds, window sizes, money constants, output suffixes).
They are listed here, together and in natural order, and used everywhere else by name.
"""

from __future__ import annotations

from decimal import Decimal

# ---- FIXED VALUES: enumerations (case-sensitive) ---------------------------------
EVENT_TYPES = ("START", "SKIP", "COMPLETE")
COUNTRIES = ("FR", "US", "DE", "BR", "JP", "GB")

# ---- FIXED VALUES: rejection reasons, in rule order --------------------------------
REASON_BAD_JSON = "JSON invalide ou tronque"
REASON_NO_EVENT_ID = "event_id manquant"
REASON_NO_USER_ID = "user_id manquant"
REASON_NO_TRACK_ID = "track_id manquant"
REASON_NO_ARTIST = "artist manquant"
REASON_BAD_EVENT_TYPE = "event_type invalide: "   # + value, or "null"
REASON_BAD_MS_PLAYED = "ms_played invalide: "     # + value, or "null"
REASON_BAD_COUNTRY = "country invalide: "         # + value, or "null"
REASON_NO_TIMESTAMP = "timestamp manquant"
REASON_BAD_TIMESTAMP = "timestamp non ISO-8601: "  # + value

# ---- FIXED VALUES: skip rate -------------------------------------------------------
SKIP_WINDOW = "10 minutes"
SKIP_GRACE = "3 hours"
FLOP_RATE = 0.70          # strictly greater than
FLOP_MIN_LISTENS = 50     # at least

# ---- FIXED VALUES: top by country --------------------------------------------------
TOP_WINDOW = "15 minutes"
TOP_SLIDE = "5 minutes"
TOP_GRACE = "3 hours"

# ---- FIXED VALUES: royalties -------------------------------------------------------
ROYALTY_PER_STREAM = Decimal("0.003")
MIN_MS_FOR_ROYALTY = 30000
MONEY_TYPE = "decimal(18,3)"

# ---- FIXED VALUES: fraud -----------------------------------------------------------
FRAUD_WINDOW_MINUTES = 5      # production value in the brief is 60
FRAUD_GRACE = "1 minute"
FRAUD_THRESHOLD = 20          # strictly greater than

# ---- FIXED VALUES: output naming <group>.<namespace>.<suffix> ----------------------
DEFAULT_GROUP = "grp02"
OUTPUT_SUFFIXES = {
    "dlq": "dlq",
    "skip_rate": "skiprate",
    "top_by_country": "top.by-country",
    "royalties": "royalties",
    "fraud_alerts": "alerts.fraud",
}

# ---- FIXED VALUES: recorded dump preview width (characters) ------------------------
PREVIEW_CHARS = 110

# Upsert keys of the keyed outputs (one row per key is the table's current state).
UPSERT_KEYS = {
    "skip_rate": ("track_id", "window_start"),
    "top_by_country": ("country", "track_id", "window_start"),
    "royalties": ("artist",),
    "fraud_alerts": ("user_id", "track_id", "window_start"),
}

# ---- FIXED VALUES: published records: key columns, joined by |, and renamed fields --------
KEY_SEPARATOR = "|"
PUBLISH_KEYS = {
    "skip_rate": ("track_id",),
    "top_by_country": ("country", "track_id"),
    "royalties": ("artist",),
    "fraud_alerts": ("user_id", "track_id"),
}
PUBLISH_NAMES = {
    "fraud_alerts": {"user_id": "userId", "track_id": "trackId", "count": "count",
                     "window_start": "windowStart", "window_end": "windowEnd"},
}


def output_name(kind: str, group: str = DEFAULT_GROUP, namespace: str = "") -> str:
    """Topic / table name of an output: ``<group>.[<namespace>.]<suffix>``."""
    parts = [group] + ([namespace] if namespace else []) + [OUTPUT_SUFFIXES[kind]]
    return ".".join(parts)
