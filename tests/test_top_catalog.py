"""Catalog latest-per-key (S2), hopping windows (W2) and the left join."""

from conftest import event, raw_frame
from playlog.operators import catalog, top_country
from playlog.operators.ingest import split


def changelog(spark, rows):
    return spark.createDataFrame(rows, "partition int, offset bigint, key string, value string")


def track(tid, title="T", artist="A", genre="G", dur=200000):
    import json
    return json.dumps({"track_id": tid, "title": title, "artist": artist, "genre": genre,
                       "duration_ms": dur})


def test_latest_per_key(spark):
    cl = changelog(spark, [
        (0, 0, "k1", track("k1", "old")), (0, 5, "k1", track("k1", "new")),
        (1, 0, "k2", track("k2")), (1, 9, "k2", None),                       # deleted
        (2, 0, "k3", track("k3", "kept")), (2, 3, "k3", '{"track_id":"k3'),  # broken newest
        (0, 7, "k4", track("k4", None)),                                      # null title
        (1, 4, "k5", None), (1, 8, "k5", track("k5", "back")),                # re-created
    ])
    got = {r.key: r.title for r in catalog.latest(cl).collect()}
    assert got == {"k1": "new", "k3": "kept", "k4": None, "k5": "back"}
    assert [r.offset for r in catalog.rejected(cl).collect()] == [3]


def test_hopping_window_membership(spark):
    v = split(raw_frame(spark, [event(timestamp="2026-07-04T14:03:21.512Z", event_type="SKIP")]))[0]
    rows = top_country.listen_counts(v).collect()
    starts = sorted(r.window.start.strftime("%H:%M") for r in rows)
    assert starts == ["13:50", "13:55", "14:00"]


def test_left_join_and_enriched_flag(spark):
    cl = changelog(spark, [(0, 0, "trk-1", track("trk-1", "Minuit", "Nova")),
                           (0, 1, "trk-2", track("trk-2", None)),
                           (0, 2, "trk-3", track("trk-3")), (0, 3, "trk-3", None)])
    v = split(raw_frame(spark, [
        event(event_id="1", track_id="trk-1"), event(event_id="2", track_id="trk-2"),
        event(event_id="3", track_id="trk-3"), event(event_id="4", track_id="trk-9"),
        event(event_id="5", track_id="trk-1", event_type="START", ms_played=0)]))[0]
    rows = top_country.top_by_country(v, catalog.lookup(cl)).collect()
    by = {}
    for r in rows:
        by.setdefault(r.track_id, set()).add((r.title, r.artist, r.enriched, r.listens))
    assert by["trk-1"] == {("Minuit", "Nova", True, 1)}      # START excluded
    assert by["trk-2"] == {(None, "A", True, 1)}             # present, null title
    assert by["trk-3"] == {(None, None, False, 1)}           # deleted
    assert by["trk-9"] == {(None, None, False, 1)}           # never catalogued
    assert len(rows) == 12


def test_broadcast_only_under_bound(spark):
    cl = changelog(spark, [(0, i, f"trk-{i}", track(f"trk-{i}")) for i in range(20)])
    small = catalog.lookup(cl, limit_bytes=1 << 20)
    big = catalog.lookup(cl, limit_bytes=10)
    assert "broadcast" in small._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in big._jdf.queryExecution().logical().toString().lower()
    v = split(raw_frame(spark, [event(track_id="trk-1")]))[0]
    plan = top_country.top_by_country(v, big)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
