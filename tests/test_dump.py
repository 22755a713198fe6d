"""Recorded dumps (S3) and their reports (O1-O3)."""

import json
import os
import tempfile

from playlog.operators import replay
from playlog.sources import dump


def write_dump(files):
    d = tempfile.mkdtemp(prefix="playlog-dump-")
    for name, lines in files.items():
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            f.write("\n".join(lines) + "\n")
    return d


def test_read_rules(spark):
    d = write_dump({
        "t.events.jsonl": [
            json.dumps({"key": "u1", "value": "v1", "ts_ms": 5}),
            "",
            "   ",
            json.dumps({"key": "u2", "value": "v2"}),                  # ts_ms missing -> 0
            json.dumps({"key": None, "value": "v3", "ts_ms": None}),   # null -> 0
            json.dumps({"key": "u4", "ts_ms": 7.9}),                   # value missing -> ""
            json.dumps({"key": "u5", "value": None, "ts_ms": "12"}),   # text digits
            "  " + json.dumps({"key": "u6", "value": "v6", "ts_ms": True}) + "  ",
            "not json",
            json.dumps({"key": "u8", "value": "v8", "ts_ms": "soon"}),
        ],
        "catalog.jsonl": [json.dumps({"key": "k", "value": "{}", "ts_ms": 6})],
    })
    parsed = dump.parse_lines(dump.read_lines(spark, d)).collect()
    assert sum(r.unreadable for r in parsed) == 2
    assert sum(r.blank for r in parsed) == 2
    recs = {r.key: (r.topic, r.value, r.ts_ms) for r in dump.read_dump(spark, d).collect()}
    assert recs == {"u1": ("t.events", "v1", 5), "u2": ("t.events", "v2", 0),
                    None: ("t.events", "v3", 0), "u4": ("t.events", "", 7),
                    "u5": ("t.events", None, 12), "u6": ("t.events", "v6", 1),
                    "k": ("catalog", "{}", 6)}


def test_merge_order_counts_and_preview(spark):
    long_value = "x" * 200
    d = write_dump({
        "b.jsonl": [json.dumps({"key": f"b{i}", "value": "vb", "ts_ms": t})
                    for i, t in enumerate([1, 3, 3, 9])],
        "a.jsonl": [json.dumps({"key": f"a{i}", "value": long_value, "ts_ms": t})
                    for i, t in enumerate([2, 3, 10])],
    })
    recs = dump.read_dump(spark, d)
    order = [r.key for r in replay.timeline(recs).collect()]
    assert order == ["b0", "a0", "a1", "b1", "b2", "b3", "a2"]
    assert [(r.topic, r.messages) for r in replay.topic_counts(recs).collect()] == [("a", 3), ("b", 4)]
    p = {r.key: r for r in replay.preview(recs).collect()}
    assert len(p["a0"].value_preview) == 110
    assert p["b0"].line == "b | b0 | vb"


def test_dump_replayed_into_the_jobs(spark):
    from decimal import Decimal
    from playlog.operators import royalties
    from playlog.operators.ingest import split
    ev = lambda i, ms: json.dumps({"event_id": f"ev-{i}", "user_id": "u", "track_id": "t",
                                   "artist": "A", "event_type": "COMPLETE", "ms_played": ms,
                                   "country": "FR", "timestamp": "2026-07-16T10:00:00Z"})
    d = write_dump({"events.jsonl": [json.dumps({"key": "u", "value": ev(i, 30000 + i), "ts_ms": i})
                                     for i in range(4)]
                    + [json.dumps({"key": "u", "value": ev(1, 30001), "ts_ms": 9}),
                       json.dumps({"key": "u", "value": "oops", "ts_ms": 10})]})
    valid, dead = split(dump.as_messages(dump.read_dump(spark, d)))
    assert dead.count() == 1
    assert [(r.paid_streams, r.total) for r in royalties.royalties(valid).collect()] == [(4, Decimal("0.012"))]
