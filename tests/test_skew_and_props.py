"""Skewed keys, and property checks of the integer coercion rules."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import event, raw_frame
from playlog import contract as C
from playlog.functions.validation import validate
from playlog.operators import royalties, skip_rate
from playlog.operators.ingest import split


def test_hot_key_with_a_third_of_rows(spark):
    # one track, one artist and one source partition hold a third of all events
    n = 3000
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        rows.append(event(event_id=f"ev-{i}", track_id="trk-hot" if hot else f"trk-{i % 50}",
                          artist="hot" if hot else f"a-{i % 7}",
                          event_type="SKIP" if i % 2 else "COMPLETE", ms_played=30000 + i,
                          timestamp=f"2026-07-16T10:{(i // 60) % 60:02d}:{i % 60:02d}Z"))
    raw = raw_frame(spark, rows)
    raw = raw.withColumn("partition", F.when(F.col("offset") % 3 == 0, 0)
                         .otherwise((F.col("offset") % 5).cast("int") + 1))
    v = split(raw)[0]
    got = {(r.track_id, r.window_start): (r.skips, r.completes)
           for r in skip_rate.skip_rate(v, grace="3 hours").collect()}
    want = {}
    for i in range(n):
        track = "trk-hot" if i % 3 == 0 else f"trk-{i % 50}"
        minute = (i // 60) % 60
        key = (track, f"2026-07-16T10:{minute // 10 * 10:02d}:00Z")
        s, c = want.get(key, (0, 0))
        want[key] = (s + 1, c) if i % 2 else (s, c + 1)
    assert got == want
    paid = {r.artist: r.paid_streams for r in royalties.royalties(v).collect()}
    assert paid["hot"] == len([i for i in range(0, n, 3) if i % 2 == 0])


def _model(value):
    """The integer rule: (reason-kind, value) for a JSON value of ms_played."""
    if value is None:
        return "null", None
    if isinstance(value, bool):
        return "bad", None
    if isinstance(value, int):
        return ("ok", value) if -2**31 <= value <= 2**31 - 1 else ("bad", None)
    if isinstance(value, float):
        return ("ok", int(value)) if -2**31 <= value <= 2**31 - 1 else ("bad", None)
    if isinstance(value, str):
        s = value.strip(" \t\n\r")
        if s in ("", "null"):
            return "null", None
        body = s[1:] if s[:1] in "+-" else s
        if body.isdigit() and body.isascii():
            x = int(s)
            return ("ok", x) if -2**31 <= x <= 2**31 - 1 else ("bad", None)
        return "bad", None
    return "bad", None


values = st.one_of(
    st.none(), st.booleans(),
    st.integers(min_value=-2**40, max_value=2**40),
    st.floats(min_value=-1e10, max_value=1e10, allow_nan=False, allow_infinity=False),
    st.text(alphabet="0123456789+- .ab", max_size=12),
    st.integers(min_value=-2**33, max_value=2**33).map(str),
    st.lists(st.integers(), max_size=2))


@settings(max_examples=5, deadline=None)
@given(st.lists(values, min_size=40, max_size=40))
def test_ms_played_rules_match_model(spark, batch):
    msgs = [event(event_id=f"e{i}", ms_played=v) for i, v in enumerate(batch)]
    rows = validate(raw_frame(spark, msgs)).orderBy("offset").collect()
    for v, r in zip(batch, rows):
        kind, want = _model(v)
        if kind == "bad":
            assert r.reason == C.REASON_BAD_JSON, (v, r.reason)
        elif kind == "null":
            assert r.reason == "ms_played invalide: null", (v, r.reason)
        else:
            assert r.ms_played == want, (v, r.ms_played)
            assert r.reason == (None if want >= 0 else f"ms_played invalide: {want}"), (v, r.reason)
