"""Streaming: stream equals batch, watermark drops over micro-batches, dedup state,
idempotent upserts."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

from conftest import RAW_SCHEMA, event
from playlog.operators import royalties, skip_rate
from playlog.operators.ingest import split, valid_events
from playlog.functions.validation import validate
from playlog.plans import queries as q
from playlog.plans import stream_queries as sq
from playlog.streaming import jobs
from playlog.streaming.sinks import read_table, upsert_batch


def test_stream_equals_batch_on_fixture(spark):
    sf = "/root/testdata/sf0.001"
    assert sorted(sq.stream_skip_rate(spark, sf).collect()) == sorted(q.skip_rate_q(spark, sf).collect())
    assert sorted(sq.stream_royalties(spark, sf).collect()) == sorted(q.royalties_q(spark, sf).collect())


def _batches(spark, batches):
    """Write each list of messages as its own parquet file (one micro-batch each)."""
    d = tempfile.mkdtemp(prefix="playlog-stream-in-")
    off = 0
    for i, msgs in enumerate(batches):
        rows = [(0, off + j, dt.datetime(2026, 7, 16, 12), "k", m) for j, m in enumerate(msgs)]
        off += len(msgs)
        spark.createDataFrame(rows, RAW_SCHEMA).coalesce(1).write.parquet(f"{d}/b{i:03d}")
        os.utime(f"{d}/b{i:03d}", (1_000_000 + i, 1_000_000 + i))
    schema = spark.createDataFrame([], RAW_SCHEMA).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/*/*.parquet")


def test_watermark_drops_late_events_over_batches(spark):
    skip = lambda i, t: event(event_id=f"e{i}", event_type="SKIP", timestamp=t)
    raw = _batches(spark, [
        [skip(0, "2026-07-16T12:00:00Z")],
        [skip(1, "2026-07-16T12:01:00Z")],
        [skip(2, "2026-07-16T12:02:00Z")],
        [skip(3, "2026-07-16T08:00:00Z"),     # 4 h late: beyond the 3 h grace
         skip(4, "2026-07-16T10:00:00Z")],    # 2 h late: kept
    ])
    paths = jobs.Paths(tempfile.mkdtemp(prefix="playlog-stream-out-"))
    valid = valid_events(validate(raw))
    jobs.start_skip_rate(valid, paths).awaitTermination()
    got = {r.window_start: r.skips for r in jobs.output(spark, paths, "skip_rate").collect()}
    assert got == {"2026-07-16T12:00:00Z": 3, "2026-07-16T10:00:00Z": 1}


def test_royalty_duplicates_across_batches_pay_once(spark):
    pay = lambda i, a="Nova Kane": event(event_id=f"ev-{i}", artist=a, ms_played=31000)
    raw = _batches(spark, [[pay(1), pay(2)], [pay(1), pay(3)], [pay(2), pay(1, "Other")]])
    paths = jobs.Paths(tempfile.mkdtemp(prefix="playlog-stream-out-"))
    jobs.start_royalties(valid_events(validate(raw)), paths).awaitTermination()
    got = {r.artist: (r.paid_streams, r.total) for r in jobs.output(spark, paths, "royalties").collect()}
    assert got == {"Nova Kane": (3, Decimal("0.009")), "Other": (1, Decimal("0.003"))}


def test_upsert_is_idempotent_per_batch(spark):
    path = tempfile.mkdtemp(prefix="playlog-upsert-") + "/t"
    w = upsert_batch(path)
    w(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), 0)
    w(spark.createDataFrame([("a", 2)], "k string, v int"), 1)
    w(spark.createDataFrame([("a", 2)], "k string, v int"), 1)      # replayed batch
    assert sorted(read_table(spark, path, ["k"]).collect()) == [("a", 2), ("b", 1)]


def test_batch_and_stream_share_operators(spark):
    # the same operator function runs on a batch frame and on a stream frame
    batch = split(spark.createDataFrame(
        [(0, 0, dt.datetime(2026, 7, 16), "k", event())], RAW_SCHEMA))[0]
    assert royalties.royalties(batch).count() == 1
    assert skip_rate.skip_rate(batch).count() == 1


def test_top_uses_catalog_current_at_emission(spark):
    import json
    paths = jobs.Paths(tempfile.mkdtemp(prefix="playlog-stream-out-"))
    cat_write = upsert_batch(paths.catalog)

    def catalog_version(batch_id, title):
        row = ("trk-1", False, "trk-1", title, "Nova", "POP", 200000)
        cat_write(spark.createDataFrame(
            [row], "key string, deleted boolean, track_id string, title string, artist string, "
                   "genre string, duration_ms int"), batch_id)

    d = tempfile.mkdtemp(prefix="playlog-stream-in-")
    schema = spark.createDataFrame([], RAW_SCHEMA).schema

    def add_file(i, msgs):
        rows = [(0, 100 * i + j, dt.datetime(2026, 7, 16, 12), "k", m) for j, m in enumerate(msgs)]
        spark.createDataFrame(rows, RAW_SCHEMA).coalesce(1).write.parquet(f"{d}/b{i:03d}")

    def run_once():
        raw = spark.readStream.schema(schema).parquet(f"{d}/*/*.parquet")
        jobs.start_top(valid_events(validate(raw)), paths).awaitTermination()
        rows = jobs.output(spark, paths, "top_by_country").collect()
        return {(r.window_start, r.title, r.listens) for r in rows
                if r.window_start == "2026-07-16T10:00:00Z"}

    catalog_version(0, "v1")
    add_file(0, [event(event_id="a", track_id="trk-1", timestamp="2026-07-16T10:01:00Z")])
    assert run_once() == {("2026-07-16T10:00:00Z", "v1", 1)}
    catalog_version(1, "v2")
    add_file(1, [event(event_id="b", track_id="trk-1", timestamp="2026-07-16T10:02:00Z")])
    assert run_once() == {("2026-07-16T10:00:00Z", "v2", 2)}


def test_royalty_dedup_ttl_bounds_state(spark):
    pay = lambda i, t: event(event_id=f"ev-{i}", ms_played=31000, timestamp=t)
    raw = _batches(spark, [[pay(1, "2026-07-16T10:00:00Z")],
                           [pay(1, "2026-07-16T10:05:00Z"), pay(2, "2026-07-16T10:06:00Z")]])
    paths = jobs.Paths(tempfile.mkdtemp(prefix="playlog-stream-out-"))
    jobs.start_royalties(valid_events(validate(raw)), paths, dedup_ttl="1 hour").awaitTermination()
    got = {r.artist: r.paid_streams for r in jobs.output(spark, paths, "royalties").collect()}
    assert got == {"Nova Kane": 2}


def test_dump_folder_as_a_stream(spark):
    import json
    from playlog.sources import dump
    d = tempfile.mkdtemp(prefix="playlog-dump-stream-")
    with open(f"{d}/t.jsonl", "w") as f:
        f.write("\n".join(json.dumps({"key": f"k{i}", "value": "v", "ts_ms": i}) for i in range(5)) + "\n\n")
    recs = dump.records(dump.stream_lines(spark, d))
    out = tempfile.mkdtemp(prefix="playlog-dump-out-")
    q = (recs.writeStream.format("parquet").option("checkpointLocation", out + "/_ck")
         .trigger(availableNow=True).start(out + "/t"))
    q.awaitTermination()
    rows = spark.read.parquet(out + "/t").collect()
    assert sorted((r.key, r.ts_ms, r.topic) for r in rows) == [(f"k{i}", i, "t") for i in range(5)]


def test_kafka_output_shaping(spark):
    from playlog.streaming.sinks import to_kafka
    df = spark.createDataFrame([("u-1", "trk-1", 21, "2026-07-16T10:00:00Z", "2026-07-16T10:05:00Z")],
                               "user_id string, track_id string, count long, window_start string, window_end string")
    row = to_kafka(df, ["user_id", "track_id"]).first()
    assert row.key == "u-1|trk-1"
    assert row.value == ('{"user_id":"u-1","track_id":"trk-1","count":21,'
                         '"window_start":"2026-07-16T10:00:00Z","window_end":"2026-07-16T10:05:00Z"}')


def test_readers_can_start_before_the_writer(spark):
    from playlog.sources import fixtures
    paths = jobs.Paths(tempfile.mkdtemp(prefix="playlog-stream-out-") + "/fresh")
    raw = fixtures.raw_messages_from(fixtures.events_stream(spark, "/root/testdata/sf0.001"))
    schema = jobs.validated_schema(raw)
    valid = jobs.valid_stream(spark, paths, schema)          # nothing written yet
    q1 = jobs.start_skip_rate(valid, paths)
    q1.awaitTermination()                                     # drains nothing, no error
    assert q1.exception() is None
    jobs.start_validation(raw, paths).awaitTermination()
    jobs.start_skip_rate(jobs.valid_stream(spark, paths, schema), paths).awaitTermination()
    assert jobs.output(spark, paths, "skip_rate").count() > 0


def test_continuous_run_matches_batch(spark):
    from playlog.plans import stream_queries
    from playlog.sources import fixtures
    sf = "/root/testdata/sf0.001"
    paths = jobs.Paths(tempfile.mkdtemp(prefix="playlog-stream-out-"))
    raw = fixtures.raw_messages_from(fixtures.events_stream(spark, sf))
    queries = jobs.run(spark, raw, paths, stream_queries._catalog_stream(spark, sf),
                       jobs.Trigger(available_now=False, every="1 second", state_partitions=4),
                       kinds=("top_by_country",), wait=False)
    try:
        for qq in queries:                 # validation first, then the consumer
            qq.processAllAvailable()
        for qq in queries[2:]:
            qq.processAllAvailable()
    finally:
        for qq in queries:
            qq.stop()
    want = q.top_by_country_q(spark, sf)
    got = jobs.output(spark, paths, "top_by_country").select(*want.columns)
    assert sorted(got.collect()) == sorted(want.collect())


def test_upserts_without_keys_keep_every_batch(spark):
    base = tempfile.mkdtemp(prefix="playlog-upsert-")
    w = upsert_batch(base + "/t")
    w(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), 0)
    w(spark.createDataFrame([("a", 2), ("c", 5)], "k string, v int"), 1)
    w(spark.createDataFrame([("b", 3)], "k string, v int"), 2)
    assert sorted(read_table(spark, base + "/t", ["k"]).collect()) == [("a", 2), ("b", 3), ("c", 5)]
