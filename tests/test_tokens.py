"""Repeated fields, numbers as written, escaped names, and what follows an object."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import event, raw_frame
from playlog import contract as C
from playlog.functions import jsonparse
from playlog.functions.validation import validate
from playlog.operators import royalties
from playlog.operators.ingest import split
from playlog.sources import dump

BASE = event(event_id="e")


def first(text):
    """`text` written before the other fields of an event."""
    return "{" + text + "," + BASE[1:]


def last(text):
    return BASE[:-1] + "," + text + "}"


UNREADABLE = [
    first('"event_id":{"a":1}'), first('"event_id":[]'), last('"country":["FR"]'),
    first('"ms_played":"x"'), first('"ms_played":true'), first('"ms_played":{}'),
    first('"ms_played":99999999999'), first('"ms_played":1e99'), first('"ms_played":"1.5"'),
    first('"event\\u005fid":{"a":{"b":["}"]}}'), first('"\\u0065vent_id" : [1]'),
    first('"x":{"event_id":1},"artist":{"n":"\\"artist\\":"}'),
]
READABLE = [
    (first('"event_id":"other"'), {"event_id": "e"}),
    (last('"event_id":"other"'), {"event_id": "other"}),
    (last('"event\\u005fid":"escaped"'), {"event_id": "escaped"}),
    (last('"user_id":1.50'), {"user_id": "1.50"}),
    (last('"user_id" :\n 1e3'), {"user_id": "1e3"}),
    (last('"user_id":-0'), {"user_id": "-0"}),
    (last('"user_id":1.0E+2,"x":[{"user_id":[]}]'), {"user_id": "1.0E+2"}),
    (last('"user_id":12345678901234567890123'), {"user_id": "12345678901234567890123"}),
    (last('"user_id":true'), {"user_id": "true"}),
    (first('"ms_played":" +7 "'), {"ms_played": 31000}),
    (first('"ms_played":null') , {"ms_played": 31000}),
    (first('"ms_played":12.9'), {"ms_played": 31000}),
    (last('"ms_played":12.9'), {"ms_played": 12}),
    (last('"note":"\\"event_id\\":1.5, \\"event_id\\": {"'), {"event_id": "e"}),
    (last('"x":{"event_id":{"event_id":[1,{"a":"]"}]}}'), {"event_id": "e"}),
    (last('"note":"\\u0041"') + ' {"event_id":{}}', {"event_id": "e"}),
    (last('"user_id":"caf\\u00e9 \\u0041\\n"'), {"user_id": "café A\n"}),
    (last('"user_id":"a","user_id":"b\\\\","user_id":"\\"c"'), {"user_id": '"c'}),
]


def test_every_value_of_a_repeated_field_counts(spark):
    got = validate(raw_frame(spark, UNREADABLE)).orderBy("offset").collect()
    assert [r["reason"] for r in got] == [C.REASON_BAD_JSON] * len(UNREADABLE)


def test_numbers_and_names_as_written(spark):
    got = validate(raw_frame(spark, [t for t, _ in READABLE])).orderBy("offset").collect()
    for (text, want), row in zip(READABLE, got):
        assert row["reason"] is None, text
        assert {k: row[k] for k in want} == want, text


def test_the_last_null_wins(spark):
    got = validate(raw_frame(spark, [last('"artist":null'), last('"ms_played":null')])).orderBy("offset")
    assert [r["reason"] for r in got.collect()] == [
        C.REASON_NO_ARTIST, C.REASON_BAD_MS_PLAYED + "null"]


def test_ids_written_differently_are_paid_twice(spark):
    texts = [event().replace('"ev-1"', n) for n in ("1.50", "1.5", "1.5", "15e-1")]
    paid = royalties.royalties(split(raw_frame(spark, texts))[0]).first()
    assert paid["paid_streams"] == 3


def test_long_and_deep_messages(spark):
    deep = "[" * 400 + "]" * 400
    texts = [last(f'"x":{deep},"event_id":"d","note":"{"a" * 300_000}"'),
             last('"note":"' + '\\"' * 100_000 + '","user_id":1.50')]
    got = validate(raw_frame(spark, texts)).orderBy("offset").collect()
    assert [(r["reason"], r["event_id"], r["user_id"]) for r in got] == [
        (None, "d", "u-1"), (None, "e", "1.50")]


def test_members_are_those_of_the_first_object(spark):
    text = '{"a":1,"b":{"a":[2,"}"]},"c":"x:,{","a":null, "d" : [ ] } {"a":9}'
    got = spark.range(1).select(jsonparse.members(F.lit(text)).alias("m")).first()["m"]
    assert [(m["name"], m["token"]) for m in got] == [
        ("a", "1"), ("b", "{"), ("c", '"x:,{"'), ("a", "null"), ("d", "[")]


@pytest.mark.parametrize("line, more", [
    ('{"a":1}', False), ('{"a":"}{"}', False), ('{"a":{"b":[{}]}}', False), ("{}", False),
    ('{"a":1}{"a":2}', True), ('{"a":1} {"a":2}', True), ('{"a":{}} 1 {}', True),
    ('{"a":"\\"}"}{}', True)])
def test_what_follows_an_object(spark, line, more):
    got = spark.range(1).select(jsonparse.more_than_one_value(F.lit(line)).alias("x")).first()["x"]
    assert got is more


def test_a_second_object_on_a_dump_line_is_set_aside(spark, tmp_path):
    good = json.dumps({"key": "k", "value": '{"a":1}{"b":2}', "ts_ms": 5})
    lines = [good, good + good, good + " " + good, good + ' {"x":{}}']
    (tmp_path / "t.jsonl").write_text("\n".join(lines))
    parsed = dump.parse_lines(dump.read_lines(spark, str(tmp_path))).orderBy("split_row").collect()
    assert [r["unreadable"] for r in parsed] == [False, True, True, True]
    assert dump.read_dump(spark, str(tmp_path)).count() == 1
