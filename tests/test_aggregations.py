"""Skip rate (A1 A2 F6), royalties (F3 A5 A6), fraud (F4 A4 F5): reference tests and
the boundary rows of the brief."""

from decimal import Decimal

from conftest import event, raw_frame
from playlog.operators import fraud, royalties, skip_rate
from playlog.operators.ingest import split


def valid_of(spark, values):
    return split(raw_frame(spark, values))[0]


def at(minute, second=0, hour=10):
    return f"2026-07-16T{hour:02d}:{minute:02d}:{second:02d}.000Z"


# ---- reference tests, Spark form ---------------------------------------------------
def test_complete_credits_a_royalty(spark):
    v = valid_of(spark, [event(event_id="ev-002", artist="Nova Kane", ms_played=31000)])
    rows = royalties.royalties(v).collect()
    assert [(r.artist, r.total, r.paid_streams) for r in rows] == [("Nova Kane", Decimal("0.003"), 1)]
    # as published: key = artist, JSON value carrying 0.003
    from playlog.streaming.sinks import to_kafka
    msg = to_kafka(royalties.royalties(v), ["artist"]).first()
    assert msg.key == "Nova Kane" and '"total":0.003' in msg.value


def test_skip_credits_nothing(spark):
    v = valid_of(spark, [event(event_id="ev-003", event_type="SKIP", ms_played=12000)])
    assert royalties.royalties(v).count() == 0


# ---- royalties -----------------------------------------------------------------------
def test_royalty_boundaries_and_dedup(spark):
    v = valid_of(spark, [
        event(event_id="a", artist="A", ms_played=29999),
        event(event_id="b", artist="A", ms_played=30000),
        event(event_id="c", artist="A", event_type="SKIP", ms_played=45000),
        event(event_id="d", artist="A", ms_played=40000),
        event(event_id="d", artist="A", ms_played=40000),         # exact duplicate
        event(event_id="e", artist="B", ms_played=40000),
        event(event_id="e", artist="C", ms_played=40000),         # same id, other artist
        event(event_id="f", artist="A", event_type="START", ms_played=40000),
    ])
    got = {r.artist: (r.paid_streams, r.total) for r in royalties.royalties(v).collect()}
    assert got == {"A": (2, Decimal("0.006")), "B": (1, Decimal("0.003")),
                   "C": (1, Decimal("0.003"))}


def test_doubled_input_leaves_royalties_unchanged(spark):
    values = [event(event_id=f"ev-{i}", artist=f"art-{i % 3}", ms_played=30000 + i)
              for i in range(40)]
    once = sorted(royalties.royalties(valid_of(spark, values)).collect())
    twice = sorted(royalties.royalties(valid_of(spark, values + values[::-1])).collect())
    assert once == twice


# ---- skip rate -------------------------------------------------------------------------
def _window(track, skips, completes, minute=0):
    out = []
    for i in range(skips):
        out.append(event(event_id=f"{track}-s{i}", track_id=track, event_type="SKIP",
                         ms_played=1000, timestamp=at(minute, i % 60)))
    for i in range(completes):
        out.append(event(event_id=f"{track}-c{i}", track_id=track, event_type="COMPLETE",
                         ms_played=200000, timestamp=at(minute + 1, i % 60)))
    return out


def test_flop_boundaries(spark):
    values = (_window("t49", 49, 0) + _window("t35of50", 35, 15) + _window("t36of50", 36, 14)
              + _window("t3of3", 3, 0)
              + [event(event_id="st", track_id="t49", event_type="START", ms_played=0,
                       timestamp=at(2))])
    rows = {r.track_id: r for r in skip_rate.skip_rate(valid_of(spark, values)).collect()}
    assert not rows["t49"].flop and rows["t49"].total == 49          # START not counted
    assert rows["t35of50"].skip_rate == 0.7 and not rows["t35of50"].flop
    assert rows["t36of50"].flop
    assert rows["t3of3"].skip_rate == 1.0 and not rows["t3of3"].flop
    r = rows["t36of50"]
    assert (r.window_start, r.window_end) == ("2026-07-16T10:00:00Z", "2026-07-16T10:10:00Z")
    assert (r.skips, r.completes, r.total) == (36, 14, 50)


def test_tumbling_windows_are_half_open(spark):
    values = [event(event_id="x1", event_type="SKIP", timestamp="2026-07-16T10:09:59.999Z"),
              event(event_id="x2", event_type="SKIP", timestamp="2026-07-16T10:10:00.000Z")]
    starts = sorted(r.window_start for r in skip_rate.skip_rate(valid_of(spark, values)).collect())
    assert starts == ["2026-07-16T10:00:00Z", "2026-07-16T10:10:00Z"]


def test_shuffled_input_gives_same_skip_rate(spark):
    values = _window("a", 40, 20) + _window("b", 10, 30, minute=12)
    r1 = sorted(skip_rate.skip_rate(valid_of(spark, values)).collect())
    r2 = sorted(skip_rate.skip_rate(valid_of(spark, values[::-1])).collect())
    assert r1 == r2


# ---- fraud -------------------------------------------------------------------------------
def _completes(n, user="u-x", track="trk-x", minute=0, prefix="f"):
    return [event(event_id=f"{prefix}{i}", user_id=user, track_id=track, ms_played=31000,
                  timestamp=at(minute, i)) for i in range(n)]


def test_fraud_threshold(spark):
    values = (_completes(20, user="u-20", prefix="a") + _completes(21, user="u-21", prefix="b")
              + _completes(11, user="u-split", minute=3, prefix="c")
              + _completes(10, user="u-split", minute=5, prefix="d")
              + [event(event_id="sk", user_id="u-20", track_id="trk-x", event_type="SKIP")])
    rows = fraud.fraud_alerts(valid_of(spark, values)).collect()
    assert [(r.user_id, r.track_id, r["count"], r.window_start, r.window_end) for r in rows] == [
        ("u-21", "trk-x", 21, "2026-07-16T10:00:00Z", "2026-07-16T10:05:00Z")]


def test_fraud_window_is_a_parameter(spark):
    values = _completes(11, user="u-h", minute=3, prefix="c") + _completes(10, user="u-h", minute=40, prefix="d")
    assert fraud.fraud_alerts(valid_of(spark, values)).count() == 0
    hourly = fraud.fraud_alerts(valid_of(spark, values), window_minutes=60).collect()
    assert [(r["count"], r.window_start) for r in hourly] == [(21, "2026-07-16T10:00:00Z")]
