"""DuckDB oracle SQL for the registered queries.

The fixture (raw messages, catalog changelog) is rebuilt from the same row expressions
as the Spark adapter (``playlog.sources.fixtures``); everything after that — JSON rules,
validation, windows, the late rule, joins, aggregates — is written independently here
in plain DuckDB SQL.
"""

from __future__ import annotations

from playlog import contract as C
from playlog.sources import fixtures as fx


def _sel(exprs: list[str]) -> str:
    return ",\n    ".join(exprs)


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


#: The two parts of an instant, written for DuckDB on their own: local time, zone.
LOCAL_RE = r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{0,9})?"
ZONE_RE = r"Z|[-+]\d\d:\d\d|[-+]\d\d:\d\d:\d\d"
#: Java's white space, spelled out (no-break spaces are not in it).
BLANK_RE = (r"[\t-\r\x1C-\x20\x{1680}\x{2000}-\x{2006}\x{2008}-\x{200A}"
            r"\x{2028}\x{2029}\x{205F}\x{3000}]*")
TRIM_RE = r"^[\x00-\x20]+|[\x00-\x20]+$"


def _written(field: str) -> str:
    """The values written for a field, in order: scalars whole, containers by their bracket.  (The
    fixtures nest no field of these names.)"""
    return (f"regexp_extract_all(value, '\"{field}\"[ \\t\\r\\n]*:[ \\t\\r\\n]*"
            r"""(\{|\[|"(?:[^"\\]|\\.)*"|[^,}\] \t\r\n]+)', 1)""")


def _nests(token: str) -> str:
    return f"({token} LIKE '{{%' OR {token} LIKE '[%')"


def _text(json_col: str, field: str) -> tuple[str, str]:
    written, last = _written(field), f"{_written(field)}[-1]"
    return (f"CASE WHEN {json_col} IS NULL OR {_nests(last)} OR {last} = 'null' THEN NULL "
            f"WHEN {last} LIKE '\"%' THEN json_extract_string({last}, '$') ELSE {last} END",
            f"coalesce(list_bool_or(list_transform({written}, lambda x: {_nests('x')})), false)")


def _int_rules(x: str) -> tuple[str, str]:
    """(value, acceptable) of one written value of an integer field."""
    low, high = -2**31, 2**31 - 1
    st = f"regexp_replace(json_extract_string({x}, '$'), '{TRIM_RE}', '', 'g')"
    text = f"{x} LIKE '\"%'"
    s_null = f"{st} IN ('', 'null')"
    s_long = f"(CASE WHEN regexp_full_match({st}, '[+-]?[0-9]+') THEN TRY_CAST({st} AS BIGINT) END)"
    whole = f"regexp_full_match({x}, '-?[0-9]+')"
    i, d = f"TRY_CAST({x} AS BIGINT)", f"TRY_CAST({x} AS DOUBLE)"
    number = f"regexp_full_match({x}, '-?[0-9].*')"
    value = (f"CASE WHEN {text} THEN CASE WHEN NOT {s_null} AND {s_long} BETWEEN {low} AND {high} "
             f"THEN CAST({s_long} AS INTEGER) END "
             f"WHEN {whole} THEN CASE WHEN {i} BETWEEN {low} AND {high} THEN CAST({i} AS INTEGER) END "
             f"WHEN {number} AND {d} BETWEEN {low} AND {high} THEN CAST(trunc({d}) AS INTEGER) END")
    ok = (f"CASE WHEN {x} = 'null' THEN true "
          f"WHEN {text} THEN {s_null} OR coalesce({s_long} BETWEEN {low} AND {high}, false) "
          f"WHEN {whole} THEN coalesce({i} BETWEEN {low} AND {high}, false) "
          f"WHEN {number} THEN coalesce({d} BETWEEN {low} AND {high}, false) ELSE false END")
    return value, ok


def _int(json_col: str, field: str) -> tuple[str, str]:
    written = _written(field)
    value, _ = _int_rules(f"{written}[-1]")
    _, ok = _int_rules("x")
    return (f"CASE WHEN {json_col} IS NOT NULL THEN {value} END",
            f"coalesce({json_col} IS NOT NULL AND list_bool_or(list_transform({written}, "
            f"lambda x: NOT ({ok}))), false)")


def _blank(x: str) -> str:
    return f"({x} IS NULL OR regexp_full_match({x}, '{BLANK_RE}'))"


def _iso_ms(x: str) -> str:
    u = f"upper({x})"
    local = f"regexp_extract({u}, '^({LOCAL_RE})', 1)"
    zone = f"substring({u}, length({local}) + 1)"
    return (f"CASE WHEN {local} <> '' AND regexp_full_match({zone}, '{ZONE_RE}') "
            f"THEN epoch_ms(TRY_CAST({u} AS TIMESTAMPTZ)) END")


def fixture_ctes() -> str:
    """CTEs ``raw`` (Kafka-shaped messages) and ``cat`` (catalog changelog)."""
    return f"""
b0 AS (SELECT {_sel(fx.DUCK_EVENTS_HEAD)} FROM events),
b AS (SELECT {_sel(fx.EVENTS_FLAGS)} FROM b0),
le AS (SELECT {_sel(fx.EVENTS_BODY)} FROM b),
r1 AS (SELECT {_sel(fx.DUCK_RAW_HEAD)} FROM le),
r2 AS (SELECT {_sel(fx.DUCK_RAW_ISO)} FROM r1),
r3 AS (SELECT {_sel(fx.RAW_JSON)} FROM r2),
r4 AS (SELECT {_sel(fx.RAW_VALUE)} FROM r3),
r5 AS (SELECT {_sel(fx.DUCK_RAW_COPIES)} FROM r4),
raw AS (SELECT {_sel(fx.quoted(fx.RAW_OUT, '"'))} FROM r5),
c0 AS (SELECT p_partkey, p_name, p_type, p_size, unnest(generate_series(0, 1)) AS ver FROM part),
cat AS (SELECT {_sel(fx.quoted(fx.CAT_BODY, '"'))} FROM c0)"""


def validation_ctes() -> str:
    """CTEs ``val`` (every message + fields + reason) and ``ve`` (valid events)."""
    fields = {}
    bads = []
    for f in ("event_id", "user_id", "track_id", "artist", "event_type", "country", "timestamp"):
        v, b = _text("j", f)
        fields[f] = v
        bads.append(b)
    ms, msb = _int("j", "ms_played")
    fields["ms_played"] = ms
    bads.append(msb)
    cols = ",\n    ".join(f"{v} AS {k}" for k, v in fields.items())
    unreadable = " OR ".join(["j IS NULL", "json_type(j) <> 'OBJECT'"] + bads)
    return f"""
j0 AS (SELECT *, CASE WHEN json_valid(value) THEN value END AS j FROM raw),
j1 AS (SELECT "partition", "offset", broker_time, key, value, j IS NULL OR json_type(j) <> 'OBJECT' AS _nojson,
    {cols},
    coalesce({unreadable}, true) AS unreadable FROM j0),
j2 AS (SELECT *, CASE WHEN NOT unreadable THEN {_iso_ms('timestamp')} END AS event_time_ms FROM j1),
val AS (SELECT *, CASE
    WHEN unreadable THEN '{C.REASON_BAD_JSON}'
    WHEN {_blank('event_id')} THEN '{C.REASON_NO_EVENT_ID}'
    WHEN {_blank('user_id')} THEN '{C.REASON_NO_USER_ID}'
    WHEN {_blank('track_id')} THEN '{C.REASON_NO_TRACK_ID}'
    WHEN {_blank('artist')} THEN '{C.REASON_NO_ARTIST}'
    WHEN NOT coalesce(event_type IN ({_in(C.EVENT_TYPES)}), false)
      THEN '{C.REASON_BAD_EVENT_TYPE}' || coalesce(event_type, 'null')
    WHEN NOT coalesce(ms_played >= 0, false)
      THEN '{C.REASON_BAD_MS_PLAYED}' || coalesce(CAST(ms_played AS VARCHAR), 'null')
    WHEN NOT coalesce(country IN ({_in(C.COUNTRIES)}), false)
      THEN '{C.REASON_BAD_COUNTRY}' || coalesce(country, 'null')
    WHEN timestamp IS NULL THEN '{C.REASON_NO_TIMESTAMP}'
    WHEN event_time_ms IS NULL THEN '{C.REASON_BAD_TIMESTAMP}' || timestamp
    END AS reason FROM j2),
ve AS (SELECT "partition", "offset", event_id, user_id, track_id, artist, event_type, ms_played,
    country, timestamp, event_time_ms, make_timestamp(event_time_ms * 1000) AS event_time
    FROM val WHERE reason IS NULL)"""


def catalog_ctes() -> str:
    """CTEs ``catp`` (parsed changelog) and ``cur`` (current catalog)."""
    fields = {}
    bads = []
    for f in ("track_id", "title", "artist", "genre"):
        v, b = _text("j", f)
        fields[f] = v
        bads.append(b)
    d, db = _int("j", "duration_ms")
    fields["duration_ms"] = d
    bads.append(db)
    cols = ",\n    ".join(f"{v} AS {k}" for k, v in fields.items())
    unreadable = " OR ".join(["j IS NULL", "json_type(j) <> 'OBJECT'"] + bads)
    return f"""
cj AS (SELECT *, CASE WHEN json_valid(value) THEN value END AS j FROM cat),
catp AS (SELECT "partition", "offset", key, value, {cols},
    NOT coalesce({unreadable}, true) AS readable FROM cj),
cur0 AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY "partition" DESC, "offset" DESC) AS rn
    FROM catp WHERE value IS NULL OR readable),
cur AS (SELECT key, track_id, title, artist, genre, duration_ms FROM cur0 WHERE rn = 1 AND value IS NOT NULL)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts)


ISO_FMT = "'%Y-%m-%dT%H:%M:%SZ'"


def _tumbling(minutes: int, ts: str = "event_time") -> str:
    return f"time_bucket(INTERVAL {minutes} MINUTE, {ts}, TIMESTAMP '1970-01-01')"


def _late_cte(name: str, src: str, where: str) -> str:
    return f"""
{name} AS (SELECT *, max(event_time) OVER (PARTITION BY "partition" ORDER BY "offset"
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stream_time FROM {src} WHERE {where})"""


def _watermark_cte(name: str, src: str, where: str, batches: int) -> str:
    """`stream_time`: the latest event of the micro-batches up to two before a row's own."""
    return f"""
w0 AS (SELECT *, "offset" // 2 * {batches} // (SELECT max("offset" // 2) + 1 FROM ve) AS mb
    FROM {src} WHERE {where}),
w1 AS (SELECT mb, max(event_time) AS latest FROM w0 GROUP BY mb),
w2 AS (SELECT a.mb, coalesce(max(b.latest), TIMESTAMP '1970-01-01') AS stream_time
    FROM w1 a LEFT JOIN w1 b ON b.mb <= a.mb - 2 GROUP BY a.mb),
{name} AS (SELECT w0.*, w2.stream_time FROM w0 JOIN w2 USING (mb))"""


def _skip_rate_sql(late_grace: str | None = None, flops_only: bool = False,
                   batches: int | None = None) -> str:
    where = "event_type IN ('SKIP', 'COMPLETE')"
    base = _with(fixture_ctes(), validation_ctes(),
                 _watermark_cte("sr0", "ve", where, batches)) if batches else _with(fixture_ctes(), validation_ctes(),
                 _late_cte("sr0", "ve", where) if late_grace else
                 f"\nsr0 AS (SELECT * FROM ve WHERE {where})")
    late = (f"WHERE ws + INTERVAL 10 MINUTE > stream_time - INTERVAL {late_grace}"
            if late_grace else "")
    sql = f"""{base}
, sr1 AS (SELECT *, {_tumbling(10)} AS ws FROM sr0),
sr2 AS (SELECT track_id, ws,
    CAST(count(*) FILTER (WHERE event_type = 'SKIP') AS INTEGER) AS skips,
    CAST(count(*) FILTER (WHERE event_type <> 'SKIP') AS INTEGER) AS completes
  FROM sr1 {late} GROUP BY track_id, ws)
SELECT track_id, strftime(ws, {ISO_FMT}) AS window_start,
  strftime(ws + INTERVAL 10 MINUTE, {ISO_FMT}) AS window_end,
  skips, completes, skips + completes AS total,
  CASE WHEN skips + completes = 0 THEN 0.0 ELSE CAST(skips AS DOUBLE) / (skips + completes) END AS skip_rate,
  (CASE WHEN skips + completes = 0 THEN 0.0 ELSE CAST(skips AS DOUBLE) / (skips + completes) END)
    > CAST({C.FLOP_RATE} AS DOUBLE) AND skips + completes >= {C.FLOP_MIN_LISTENS} AS flop
FROM sr2"""
    if flops_only:
        sql = f"SELECT * FROM ({sql}) WHERE flop"
    return sql


def _top_sql(late_grace: str | None = None, unknown_only: bool = False) -> str:
    where = "event_type <> 'START'"
    base = _with(fixture_ctes(), validation_ctes(), catalog_ctes(),
                 _late_cte("t0", "ve", where) if late_grace else
                 f"\nt0 AS (SELECT * FROM ve WHERE {where})")
    late = (f"WHERE ws + INTERVAL 15 MINUTE > stream_time - INTERVAL {late_grace}"
            if late_grace else "")
    sql = f"""{base}
, t1 AS (SELECT *, {_tumbling(5)} - k * INTERVAL 5 MINUTE AS ws
    FROM (SELECT *, unnest([0, 1, 2]) AS k FROM t0)),
t2 AS (SELECT country, track_id, ws, count(*) AS listens FROM t1 {late} GROUP BY country, track_id, ws)
SELECT t2.country, t2.track_id, cur.title, cur.artist, cur.genre,
  strftime(ws, {ISO_FMT}) AS window_start, strftime(ws + INTERVAL 15 MINUTE, {ISO_FMT}) AS window_end,
  t2.listens, cur.key IS NOT NULL AS enriched
FROM t2 LEFT JOIN cur ON t2.track_id = cur.key"""
    if unknown_only:
        sql = f"SELECT * FROM ({sql}) WHERE NOT enriched"
    return sql


def _fraud_sql(minutes: int, late_grace: str | None = None) -> str:
    where = "event_type = 'COMPLETE'"
    base = _with(fixture_ctes(), validation_ctes(),
                 _late_cte("f0", "ve", where) if late_grace else
                 f"\nf0 AS (SELECT * FROM ve WHERE {where})")
    late = (f"WHERE ws + INTERVAL {minutes} MINUTE > stream_time - INTERVAL {late_grace}"
            if late_grace else "")
    return f"""{base}
, f1 AS (SELECT *, {_tumbling(minutes)} AS ws FROM f0)
SELECT user_id, track_id, count(*) AS count, strftime(ws, {ISO_FMT}) AS window_start,
  strftime(ws + INTERVAL {minutes} MINUTE, {ISO_FMT}) AS window_end
FROM f1 {late} GROUP BY user_id, track_id, ws HAVING count(*) > {C.FRAUD_THRESHOLD}"""


def _royalties_sql() -> str:
    return f"""{_with(fixture_ctes(), validation_ctes())}
SELECT artist, count(*) AS paid_streams, CAST(count(*) * {C.ROYALTY_PER_STREAM} AS DECIMAL(18,3)) AS total
FROM (SELECT DISTINCT artist, event_id FROM ve
      WHERE event_type = 'COMPLETE' AND ms_played >= {C.MIN_MS_FOR_ROYALTY})
GROUP BY artist"""


def _paid_sql() -> str:
    return f"""{_with(fixture_ctes(), validation_ctes())}
SELECT DISTINCT artist, event_id FROM ve
WHERE event_type = 'COMPLETE' AND ms_played >= {C.MIN_MS_FOR_ROYALTY}"""


def _dlq_json(orig: str, reason: str) -> str:
    return (f"'{{\"original\":' || coalesce(to_json({orig}), 'null') || ',\"reason\":' "
            f"|| to_json({reason}) || '}}'")


#: The fields of the published records: (JSON name, column, is it text).
RECORDS = {
    "skip_rate": (("track_id",), [
        ("track_id", "track_id", True), ("window_start", "window_start", True),
        ("window_end", "window_end", True), ("skips", "skips", False),
        ("completes", "completes", False), ("total", "total", False),
        ("skip_rate", "skip_rate", False), ("flop", "flop", False)]),
    "top_by_country": (("country", "track_id"), [
        ("country", "country", True), ("track_id", "track_id", True), ("title", "title", True),
        ("artist", "artist", True), ("genre", "genre", True), ("window_start", "window_start", True),
        ("window_end", "window_end", True), ("listens", "listens", False),
        ("enriched", "enriched", False)]),
    "royalties": (("artist",), [
        ("artist", "artist", True), ("paid_streams", "paid_streams", False),
        ("total", "total", False)]),
    "fraud_alerts": (("user_id", "track_id"), [
        ("userId", "user_id", True), ("trackId", "track_id", True), ("count", '"count"', False),
        ("windowStart", "window_start", True), ("windowEnd", "window_end", True)]),
}


def _record_sql(kind: str, sql: str) -> str:
    keys, fields = RECORDS[kind]
    body = " || ',' || ".join(
        f"'\"{n}\":' || " + (f"coalesce(CAST(to_json({c}) AS VARCHAR), 'null')" if text
                             else f"CAST({c} AS VARCHAR)") for n, c, text in fields)
    return (f"SELECT '{C.output_name(kind)}' AS topic, {' || chr(124) || '.join(keys)} AS key, "
            f"'{{' || {body} || '}}' AS value FROM ({sql})")


def _records_sql(outputs: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(_record_sql(k, q) for k, q in outputs.items())


def _batch_job_sql() -> str:
    records = _records_sql({
        "skip_rate": _skip_rate_sql(late_grace="3 HOUR"), "top_by_country": _top_sql(late_grace="3 HOUR"),
        "royalties": _royalties_sql(),
        "fraud_alerts": _fraud_sql(C.FRAUD_WINDOW_MINUTES, late_grace="1 MINUTE")})
    return f"""{records}
UNION ALL
SELECT * FROM ({_with(fixture_ctes(), validation_ctes())}
SELECT '{C.output_name("dlq")}' AS topic, key, {_dlq_json('value', 'reason')} AS value
FROM val WHERE reason IS NOT NULL)"""


def _event_time_resolved_sql() -> str:
    return f"""{_with(fixture_ctes(), validation_ctes())}
, e0 AS (SELECT *, coalesce(event_time_ms, CASE WHEN epoch_ms(broker_time) >= 0 THEN epoch_ms(broker_time) END) AS base FROM val),
e1 AS (SELECT *, max(base) OVER (PARTITION BY "partition" ORDER BY "offset"
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pt FROM e0)
SELECT "partition", "offset",
  coalesce(base, CASE WHEN pt >= 0 THEN pt END, CAST(0 AS BIGINT)) AS resolved_time_ms,
  CASE WHEN event_time_ms IS NOT NULL THEN 'payload' WHEN epoch_ms(broker_time) >= 0 THEN 'broker'
       WHEN pt >= 0 THEN 'partition_time' ELSE 'zero' END AS time_source
FROM e1"""


def oracle() -> dict[str, str]:
    v = _with(fixture_ctes(), validation_ctes())
    cat = _with(fixture_ctes(), catalog_ctes())
    sql = {
        "validated_events": f"""{v}
SELECT "partition", "offset", event_id, user_id, track_id, artist, event_type, ms_played, country,
  timestamp, event_time_ms FROM ve""",
        "dlq_messages": f"""{v}
SELECT "partition", "offset", key, value AS original, reason, {_dlq_json('value', 'reason')} AS dlq_value
FROM val WHERE reason IS NOT NULL""",
        "dlq_reason_counts": f"""{v}
SELECT reason, count(*) AS messages FROM val WHERE reason IS NOT NULL GROUP BY reason""",
        "ingest_totals": f"""{v}
SELECT count(*) AS messages, count(*) FILTER (WHERE reason IS NULL) AS valid,
  count(*) FILTER (WHERE reason IS NOT NULL) AS dead_letters FROM val""",
        "event_time_resolved": _event_time_resolved_sql(),
        "skip_rate": _skip_rate_sql(),
        "flops": _skip_rate_sql(flops_only=True),
        "stream_skip_rate_batches": _skip_rate_sql(late_grace="30 MINUTE", batches=6),
        "late_filtered_skip_rate": _skip_rate_sql(late_grace="1 HOUR"),
        "catalog_latest": f"{cat}\nSELECT * FROM cur",
        "catalog_rejected": f"""{cat}
SELECT "partition", "offset", key, value FROM catp WHERE value IS NOT NULL AND NOT readable""",
        "top_by_country": _top_sql(),
        "top_unknown_tracks": _top_sql(unknown_only=True),
        "late_filtered_top": _top_sql(late_grace="1 HOUR"),
        "royalties": _royalties_sql(),
        "royalty_eligible_dedup": _paid_sql(),
        "fraud_alerts": _fraud_sql(C.FRAUD_WINDOW_MINUTES),
        "fraud_alerts_hourly": _fraud_sql(60),
        "late_filtered_fraud": _fraud_sql(C.FRAUD_WINDOW_MINUTES, late_grace="1 MINUTE"),
        "published_records": _records_sql({
            "skip_rate": _skip_rate_sql(), "top_by_country": _top_sql(),
            "royalties": _royalties_sql(), "fraud_alerts": _fraud_sql(C.FRAUD_WINDOW_MINUTES)}),
        "batch_job_outputs": _batch_job_sql(),
    }
    from playlog.plans import replay_oracle, stream_oracle
    sql.update(replay_oracle.oracle(fixture_ctes))
    sql.update(stream_oracle.oracle(sql))
    return sql
