"""Late-data rule (W5) and event-time resolution."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import event, raw_frame
from playlog.operators import fraud, skip_rate
from playlog.operators.ingest import resolve_event_time, split
from playlog.operators.windows import running_max
from playlog.functions.validation import validate


def test_running_max_matches_plain_window(spark):
    rnd = random.Random(7)
    rows = [(p, o, rnd.randint(0, 1000)) for p in range(3) for o in rnd.sample(range(500), 200)]
    df = spark.createDataFrame(rows, "p int, o bigint, v int")
    plain = Window.partitionBy("p").orderBy("o")
    want = df.select("p", "o", F.max("v").over(plain.rowsBetween(Window.unboundedPreceding, 0)).alias("m"),
                     F.max("v").over(plain.rowsBetween(Window.unboundedPreceding, -1)).alias("mx"))
    got = running_max(df, "v", ["p"], "o", "m", block_rows=16)
    got = running_max(got, "v", ["p"], "o", "mx", inclusive=False, block_rows=7)
    assert sorted(want.collect()) == sorted(got.select("p", "o", "m", "mx").collect())


def _seq(ts_list, **kw):
    return [event(event_id=f"e{i}", timestamp=t, **kw) for i, t in enumerate(ts_list)]


def test_late_event_kept_within_grace_dropped_beyond(spark):
    # stream time reaches 12:00; an event of 10:00 (2 h late) is kept with a 3 h grace,
    # dropped with 1 h; one of 11:55 stays in both.
    msgs = _seq(["2026-07-16T12:00:00Z", "2026-07-16T10:00:00Z", "2026-07-16T11:55:00Z"],
                event_type="SKIP")
    v = split(raw_frame(spark, msgs))[0]
    kept = {r.window_start for r in skip_rate.skip_rate(v, grace="3 hours").collect()}
    assert kept == {"2026-07-16T12:00:00Z", "2026-07-16T10:00:00Z", "2026-07-16T11:50:00Z"}
    kept = {r.window_start for r in skip_rate.skip_rate(v, grace="1 hour").collect()}
    assert kept == {"2026-07-16T12:00:00Z", "2026-07-16T11:50:00Z"}


def test_stream_time_is_per_partition_and_in_order(spark):
    late = "2026-07-16T10:00:00Z"
    a = raw_frame(spark, _seq(["2026-07-16T12:00:00Z"], event_type="SKIP"), partition=0)
    # partition 1 never saw 12:00, so its 10:00 event is on time there
    b = raw_frame(spark, _seq([late], event_type="SKIP"), partition=1)
    # in partition 2 the late event comes first, before stream time moved
    c = raw_frame(spark, _seq([late, "2026-07-16T12:00:00Z"], event_type="SKIP"), partition=2)
    v = split(a.unionByName(b).unionByName(c))[0]
    rows = skip_rate.skip_rate(v, grace="1 hour").collect()
    got = {r.window_start: r.skips for r in rows}
    assert got == {"2026-07-16T12:00:00Z": 2, "2026-07-16T10:00:00Z": 2}


def test_hopping_window_late_rule_is_per_window(spark):
    from playlog.operators import top_country
    from playlog.operators.catalog import lookup
    # stream time 10:40; event at 10:14 sits in windows ending 10:15, 10:20, 10:25;
    # with grace 20 min only windows ending after 10:20 are still open.
    msgs = _seq(["2026-07-16T10:40:00Z", "2026-07-16T10:14:00Z"])
    v = split(raw_frame(spark, msgs))[0]
    empty = spark.createDataFrame([], "partition int, offset bigint, key string, value string")
    rows = top_country.top_by_country(v, lookup(empty), grace="20 minutes").collect()
    ends = sorted(r.window_end for r in rows if r.window_end < "2026-07-16T10:30:00Z")
    assert ends == ["2026-07-16T10:25:00Z"]


def test_fraud_grace_one_minute(spark):
    msgs = (_seq([f"2026-07-16T10:10:{i:02d}Z" for i in range(1)])
            + [event(event_id=f"f{i}", user_id="u-f", track_id="t-f", timestamp=f"2026-07-16T10:01:{i:02d}Z")
               for i in range(25)])
    v = split(raw_frame(spark, msgs))[0]
    assert fraud.fraud_alerts(v).count() == 1
    assert fraud.fraud_alerts(v, grace="1 minute").count() == 0


def test_resolved_event_time(spark):
    import datetime as dt
    rows = [(0, 0, dt.datetime(2026, 7, 16, 9, 0), "k", event(timestamp="2026-07-16T10:00:00Z")),
            (0, 1, dt.datetime(2026, 7, 16, 9, 30), "k", event(timestamp="hier")),
            (0, 2, dt.datetime(1969, 12, 31, 23, 0), "k", "poison"),
            (1, 0, dt.datetime(1969, 12, 31, 23, 0), "k", "poison")]
    raw = spark.createDataFrame(rows, "partition int, offset bigint, broker_time timestamp, key string, value string")
    got = {(r.partition, r.offset): (r.resolved_time_ms, r.time_source)
           for r in resolve_event_time(validate(raw)).collect()}
    t10 = int(dt.datetime(2026, 7, 16, 10, 0, tzinfo=dt.timezone.utc).timestamp() * 1000)
    t930 = t10 - 30 * 60 * 1000
    assert got[(0, 0)] == (t10, "payload")
    assert got[(0, 1)] == (t930, "broker")
    assert got[(0, 2)] == (t10, "partition_time")
    assert got[(1, 0)] == (0, "zero")


def test_running_max_several_values_in_one_pass(spark):
    rnd = random.Random(11)
    rows = [(p, o, rnd.randint(0, 1000), rnd.random() < 0.4) for p in range(2)
            for o in rnd.sample(range(300), 120)]
    df = spark.createDataFrame(rows, "p int, o bigint, v int, c boolean")
    plain = Window.partitionBy("p").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    cond = F.when(F.col("c"), F.col("v"))
    want = df.select("p", "o", F.max("v").over(plain).alias("a"), F.max(cond).over(plain).alias("b"))
    got = running_max(df, ["v", cond], ["p"], "o", ["a", "b"], block_rows=10)
    assert sorted(want.collect()) == sorted(got.select("p", "o", "a", "b").collect())
    assert got.columns == ["p", "o", "v", "c", "a", "b"]


def test_running_max_holds_few_blocks_a_task(spark):
    """Hierarchical prefix: blocks of 2, at most 4 blocks a window, five levels."""
    rnd = random.Random(3)
    rows = [(p, o, rnd.choice([None, rnd.randint(0, 1000)])) for p in range(2)
            for o in rnd.sample(range(1000), 400)]
    df = spark.createDataFrame(rows, "p int, o bigint, v int")
    for inclusive, end in ((True, 0), (False, -1)):
        plain = Window.partitionBy("p").orderBy("o").rowsBetween(Window.unboundedPreceding, end)
        want = df.select("p", "o", F.max("v").over(plain).alias("m"))
        got = running_max(df, "v", ["p"], "o", "m", inclusive=inclusive, block_rows=2, fan=4,
                          order_bits=10)
        key = lambda r: (r[0], r[1])
        assert sorted(want.collect(), key=key) == sorted(got.select("p", "o", "m").collect(), key=key)


def _random_events(spark, seed, n=600):
    """Two partitions whose time moves on unevenly, with late and early events."""
    rnd = random.Random(seed)
    rows, now = [], [0, 5000]
    for o in range(n):
        p = rnd.random() < 0.3
        now[p] += rnd.choice([0, 1, 7, 60, 400])
        t = now[p] - rnd.choice([0, 0, 0, 30, 600, 3000, 9000]) + rnd.choice([0, 0, 0, 0, 1500])
        rows.append((int(p), 3 * o + 7, t, f"k{o % 5}"))
    rows += [(None, 1, 100, "k"), (None, 2, 90000, "k"), (None, 3, 50, "k")]
    return spark.createDataFrame(rows, "partition int, offset bigint, s bigint, k string").select(
        "partition", "offset", F.timestamp_seconds(F.col("s") - 4000).alias("event_time"), "k")


def test_late_windows_match_the_per_record_rule(spark, monkeypatch):
    from playlog.operators import windows

    monkeypatch.setattr(windows, "INTERVAL", 400_000_000)
    past = Window.partitionBy("partition").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    for seed, (size, slide, grace) in enumerate([
            ("10 minutes", None, "20 minutes"), ("15 minutes", "5 minutes", "0 seconds"),
            ("5 minutes", "2 minutes", "1 minute"), ("10 minutes", None, "3 hours")]):
        df = _random_events(spark, seed).cache()
        window = F.window("event_time", size, slide) if slide else F.window("event_time", size)
        plain = (df.withColumn("_s", F.max("event_time").over(past))
                 .select("*", window.alias("window"))
                 .where(F.col("window.end") > F.col("_s") - F.expr(f"INTERVAL {grace}")).drop("_s"))
        want = sorted(map(repr, plain.collect()))
        assert seed == 3 or 0 < len(want) < df.count() * 3
        for limit in (None, 40 * windows.CLOSING_BYTES, 0):
            got = windows.late_windows(df, "event_time", size, slide, grace, limit_bytes=limit)
            assert sorted(map(repr, got.collect())) == want, (size, slide, grace, limit)


def test_the_late_rule_shuffles_no_event(spark, tmp_path):
    """One broadcast join ahead of the partial counts; beyond the limit only events between an
    interval's first and last closing go to the exact table."""
    from playlog.operators import windows

    _random_events(spark, 1, 2000).withColumn("event_type", F.lit("SKIP")).withColumnRenamed(
        "k", "track_id").write.parquet(f"{tmp_path}/valid")
    valid = spark.read.parquet(f"{tmp_path}/valid")
    counts = skip_rate.skip_rate(valid, grace="10 minutes")
    counts.collect()
    plan = counts._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("BroadcastHashJoin") == 1 and plan.count("SortMergeJoin") == 0
    moved = [x for x in plan.split("\n") if "Exchange" in x and "Broadcast" not in x]
    assert moved and all("hashpartitioning(track_id" in x for x in moved)

    few = windows.late_windows(valid, "event_time", "10 minutes", None, "10 minutes",
                               limit_bytes=8 * windows.CLOSING_BYTES)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 2
    assert "_first" in plan and "_last" in plan
