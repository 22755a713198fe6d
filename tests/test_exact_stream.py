"""The per-record late rule on streams, and recorded dumps streamed in line order."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from playlog.operators import skip_rate
from playlog.streaming import exact, jobs


def _listens(spark, tmp_path, batches):
    """Three partitions that move at their own speed, cut into micro-batches in offset order
    and written shuffled; one far in the future for pandas."""
    rnd = random.Random(8)
    rows, now = [], [0, 0, 0]
    for o in range(400):
        p = rnd.randrange(3)
        now[p] += rnd.choice([0, 5, 60, 500]) * (p + 1)
        late = rnd.choice([0, 0, 0, 100, 1500, 4000])
        rows.append((p, o, now[p] - late, rnd.choice(["SKIP", "COMPLETE"]), f"t{o % 4}"))
    rows.append((2, 400, 9_000_000_000, "SKIP", "t1"))
    rows += [(2, 401, 10, "SKIP", "t1"), (1, 402, now[1], "START", "t1")]
    df = spark.createDataFrame(rows, "partition int, offset bigint, s bigint, event_type string, track_id string"
                               ).select("partition", "offset", F.timestamp_seconds("s").alias("event_time"),
                                        "event_type", "track_id")
    path = f"{tmp_path}/in"
    for b in range(batches):
        (df.where(F.expr(f"offset * {batches} div 403 = {b}")).orderBy(F.hash("offset")).coalesce(1)
         .write.mode("append").parquet(path))
    stream = (spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path))
    return df, stream


def test_every_record_is_judged_like_in_batch(spark, tmp_path):
    df, stream = _listens(spark, tmp_path, 5)
    paths = jobs.Paths(f"{tmp_path}/out")
    trigger = jobs.Trigger(state_partitions=3)
    queries = exact.start_skip_rate(stream, paths, trigger, grace="10 minutes")
    for q in queries:
        q.awaitTermination()
    assert queries[0].recentProgress[-1]["batchId"] >= 4
    want = skip_rate.skip_rate(df, grace="10 minutes")
    got = jobs.output(spark, paths, "skip_rate")
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert want.count() < skip_rate.skip_rate(df).count()


def test_stream_times_are_those_of_the_partition(spark, tmp_path):
    df, stream = _listens(spark, tmp_path, 4)
    query, path, schema = exact.start_on_time(
        stream, jobs.Paths(f"{tmp_path}/out"), "all", [], "10 minutes", "5 minutes", "0 seconds",
        jobs.Trigger(state_partitions=2))
    query.awaitTermination()
    past = Window.partitionBy("partition").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    want = (df.withColumn("_s", F.max("event_time").over(past))
            .select("offset", "_s", F.window("event_time", "10 minutes", "5 minutes").alias("w"))
            .where("w.end > _s").selectExpr("offset", "unix_micros(w.end) AS e"))
    got = spark.read.schema(schema).parquet(path).selectExpr("offset", "unix_micros(window.end) AS e")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_a_dump_streams_in_line_order(spark, tmp_path):
    """Unsorted, tied times over three files and many splits: the last line is the state."""
    import json
    import os

    from playlog.operators import catalog
    from playlog.streaming import dumps

    rnd = random.Random(2)
    for f in range(3):
        lines = [json.dumps({"key": f"k{i % 3}", "ts_ms": rnd.choice([5, 5, 9, 1]), "value": json.dumps(
            {"track_id": f"k{i % 3}", "title": f"f{f}-{i}"})}) for i in range(20 + 5 * f)]
        # the order of modification is not that of the names
        path = tmp_path / f"in{2 - f}.jsonl"
        path.write_text("\n".join([*lines, "broken", ""]) + "\n")
        os.utime(path, (1_000_000 + 100 * f,) * 2)
    root = f"{tmp_path}/root"
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        query, messages = dumps.start_messages(spark, str(tmp_path), root)
        query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(p.name for p in (tmp_path / "root" / "messages").glob("_batch=*")) == [
        f"_batch={i}" for i in range(3)]
    table = spark.read.schema(dumps.MESSAGE).parquet(f"{root}/messages")
    assert table.count() == 75 and table.select("offset").distinct().count() == 75
    paths = jobs.Paths(f"{tmp_path}/out")
    jobs.start_catalog(messages, paths).awaitTermination()
    got = {r["key"]: r["title"] for r in jobs.current_catalog(spark, paths).collect()}
    assert got == {"k0": "f2-27", "k1": "f2-28", "k2": "f2-29"}
    assert catalog.latest(table.drop("_batch")).count() == 3

    # a micro-batch that comes again leaves what it wrote
    before = sorted(str(p) for p in (tmp_path / "root" / "messages").rglob("*.parquet"))
    dumps.place_lines(f"{root}/messages")(spark.createDataFrame([], "topic string, file_name string, "
                                                                "split_start long, line string"), 1)
    assert sorted(str(p) for p in (tmp_path / "root" / "messages").rglob("*.parquet")) == before


def test_dump_files_a_micro_batch(spark, tmp_path):
    from playlog.streaming import dumps

    for f in range(5):
        (tmp_path / f"t{f}.jsonl").write_text('{"key":"k","value":"v","ts_ms":1}\n')
    query, _ = dumps.start_messages(spark, str(tmp_path), f"{tmp_path}/root", max_files=2)
    query.awaitTermination()
    assert len(list((tmp_path / "root" / "messages").glob("_batch=*"))) == 3
