"""Validation rules V1-V10, parse coercions (C1), ISO instants (C6) and routing."""

import pytest
from pyspark.sql import functions as F

from conftest import event, raw_frame, _MISSING
from playlog import contract as C
from playlog.functions.timefmt import parse_iso_instant
from playlog.functions.validation import validate
from playlog.operators.ingest import invalid_messages, split, valid_events

E = '{"event_id":"e","user_id":"u","track_id":"t","artist":"a","event_type":"SKIP","country":"FR","timestamp":"2026-07-16T10:00:00Z","ms_played":%s}'


def reasons(spark, values):
    rows = validate(raw_frame(spark, values)).orderBy("offset").select("reason", "ms_played").collect()
    return [(r.reason, r.ms_played) for r in rows]


def test_reference_dlq_case(spark):
    # event_type UNKNOWN goes to the DLQ with a reason naming event_type
    valid, dlq = split(raw_frame(spark, [event(event_id="ev-001", artist="Test",
                                                     event_type="UNKNOWN", ms_played=5000)]))
    assert valid.count() == 0
    row = dlq.collect()[0]
    assert "event_type invalide" in row.reason
    assert '"reason":"event_type invalide: UNKNOWN"' in row.dlq_value
    assert row.original.startswith('{"event_id": "ev-001"')


@pytest.mark.parametrize("value,reason", [
    (None, C.REASON_BAD_JSON), ("", C.REASON_BAD_JSON), ("null", C.REASON_BAD_JSON),
    ("[1,2]", C.REASON_BAD_JSON), ('"text"', C.REASON_BAD_JSON), ('{"event_id": "ev', C.REASON_BAD_JSON),
    ("poison", C.REASON_BAD_JSON), ("{'event_id':'x'}", C.REASON_BAD_JSON),
    ("{}", C.REASON_NO_EVENT_ID),
    (event(event_id="  "), C.REASON_NO_EVENT_ID),
    (event(event_id=" "), C.REASON_NO_EVENT_ID),
    (event(user_id=_MISSING), C.REASON_NO_USER_ID),
    (event(track_id=None), C.REASON_NO_TRACK_ID),
    (event(artist=""), C.REASON_NO_ARTIST),
    (event(event_type=None), "event_type invalide: null"),
    (event(event_type="skip"), "event_type invalide: skip"),
    (event(ms_played=-1), "ms_played invalide: -1"),
    (event(ms_played=None), "ms_played invalide: null"),
    (event(country="fr"), "country invalide: fr"),
    (event(country=_MISSING), "country invalide: null"),
    (event(timestamp=_MISSING), C.REASON_NO_TIMESTAMP),
    (event(timestamp=""), "timestamp non ISO-8601: "),
    (event(timestamp="hier a 15h"), "timestamp non ISO-8601: hier a 15h"),
    (event(timestamp="2026-07-16"), "timestamp non ISO-8601: 2026-07-16"),
    (event(timestamp="2026-07-16 10:00:00Z"), "timestamp non ISO-8601: 2026-07-16 10:00:00Z"),
    (event(timestamp="2026-07-16T10:00:00"), "timestamp non ISO-8601: 2026-07-16T10:00:00"),
    (event(timestamp="2026-02-30T10:00:00Z"), "timestamp non ISO-8601: 2026-02-30T10:00:00Z"),
    (event(), None),
])
def test_rules_in_order(spark, value, reason):
    assert reasons(spark, [value])[0][0] == reason


@pytest.mark.parametrize("ms,reason,value", [
    ("12", None, 12), ('"12"', None, 12), ('" 12 "', None, 12), ('"+12"', None, 12),
    ("12.7", None, 12), ("-0.5", None, 0), ("1e3", None, 1000), ("2147483647", None, 2147483647),
    ('""', "ms_played invalide: null", None), ('"null"', "ms_played invalide: null", None),
    ("null", "ms_played invalide: null", None),
    ('"douze"', C.REASON_BAD_JSON, None), ('"12.5"', C.REASON_BAD_JSON, None),
    ("99999999999", C.REASON_BAD_JSON, None), ("2147483648", C.REASON_BAD_JSON, None),
    ("1e30", C.REASON_BAD_JSON, None), ("true", C.REASON_BAD_JSON, None),
    ("{}", C.REASON_BAD_JSON, None), ("[12]", C.REASON_BAD_JSON, None),
])
def test_ms_played_coercion(spark, ms, reason, value):
    got = reasons(spark, [E % ms])[0]
    assert got[0] == reason
    if reason is None:
        assert got[1] == value


def test_text_field_coercion_and_json_tolerance(spark):
    values = [
        E.replace('"user_id":"u"', '"user_id":558') % 1,          # number -> text
        E.replace('"user_id":"u"', '"user_id":true') % 1,         # boolean -> text
        E.replace('"user_id":"u"', '"user_id":{"id":1}') % 1,     # object -> unreadable
        E.replace('"user_id":"u"', '"user_id":["u"]') % 1,        # array -> unreadable
        (E % 1) + " trailing",                                     # text after the object
        (E % 1).replace('"artist":"a"', '"artist":"a","artist":"b"'),  # last wins
        (E % 1).replace('{', '{"extra":{"deep":[1,2]},', 1),       # unknown field ignored
        "﻿" + (E % 1),                                        # byte-order mark
        (E % 1).replace('"a"', '"a\nb"'),                          # raw line break in a string
    ]
    rows = validate(raw_frame(spark, values)).orderBy("offset").collect()
    assert rows[0].user_id == "558" and rows[0].reason is None
    assert rows[1].user_id == "true" and rows[1].reason is None
    assert rows[2].reason == C.REASON_BAD_JSON
    assert rows[3].reason == C.REASON_BAD_JSON
    assert rows[4].reason is None
    assert rows[5].artist == "b"
    assert rows[6].reason is None
    assert rows[7].reason == C.REASON_BAD_JSON
    assert rows[8].reason == C.REASON_BAD_JSON


@pytest.mark.parametrize("text,iso", [
    ("2026-07-04T14:03:21.512Z", "2026-07-04 14:03:21.512"),
    ("2026-07-04t14:03:21z", "2026-07-04 14:03:21"),
    ("2026-07-04T14:03:21+02:00", "2026-07-04 12:03:21"),
    ("2026-07-04T14:03:21-00:30", "2026-07-04 14:33:21"),
    ("2026-07-04T24:00:00Z", "2026-07-05 00:00:00"),
    ("2026-07-04T23:59:60Z", "2026-07-04 23:59:59"),
    ("2026-07-04T14:03:21.123456789Z", "2026-07-04 14:03:21.123456"),
    ("2026-07-04T14:03Z", None), ("2026-07-04", None), ("2026-07-04 14:03:21Z", None),
    ("2026-13-01T10:00:00Z", None), ("2026-07-04T10:00:60Z", None), ("hier", None),
])
def test_iso_instant(spark, text, iso):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(F.date_format(parse_iso_instant(F.col("t")), "yyyy-MM-dd HH:mm:ss.SSSSSS")
                    .alias("x")).first().x
    if iso is None:
        assert got is None
    else:
        whole, _, frac = iso.partition(".")
        assert got == f"{whole}.{frac:0<6}"


def test_split_is_a_partition_of_the_input(spark):
    values = [event(event_id=f"ev-{i}", event_type=["START", "SKIP", "NOPE"][i % 3])
              for i in range(30)] + [None, "", "x"]
    raw = raw_frame(spark, values)
    v = validate(raw)
    good, bad = valid_events(v), invalid_messages(v)
    assert good.count() + bad.count() == raw.count()
    keys = {r.offset for r in good.collect()} & {r.offset for r in bad.collect()}
    assert not keys
    assert {r.reason for r in bad.collect()} == {"event_type invalide: NOPE", C.REASON_BAD_JSON}


def test_dlq_json_keeps_null_original(spark):
    row = invalid_messages(validate(raw_frame(spark, [None]))).first()
    assert row.dlq_value == '{"original":null,"reason":"JSON invalide ou tronque"}'


def test_brace_starting_text_is_still_text(spark):
    values = [event(artist="{The Band}"), event(artist="[Live]"), event(artist='{"x":1}'),
              (E % 1).replace('"artist":"a"', '"artist":{"x":1}')]
    rows = validate(raw_frame(spark, values)).orderBy("offset").collect()
    assert [(r.artist, r.reason) for r in rows[:3]] == [
        ("{The Band}", None), ("[Live]", None), ('{"x":1}', None)]
    assert rows[3].reason == C.REASON_BAD_JSON


def test_pre_1970_instant_is_an_ordinary_event(spark):
    row = validate(raw_frame(spark, [event(timestamp="1969-12-31T23:00:00Z")])).first()
    assert row.reason is None and row.event_time_ms == -3600000
