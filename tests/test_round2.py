"""Nothing depends silently on surroundings; published records; job options; dump order."""

import json

import pytest

from playlog import contract as C
from playlog import session
from playlog.functions.timefmt import parse_iso_instant
from playlog.operators import catalog
from playlog.sources import dump
from playlog.streaming import jobs
from playlog.streaming.sinks import publish
from pyspark.sql import functions as F


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


@pytest.mark.parametrize("text, ok", [
    ("2026-07-04T00:00:00+02", False), ("2026-07-04T00:00:00-05", False),
    ("2026-07-04T00:00:00+02:00", True), ("2026-07-04T00:00:00+02:00:30", True),
    ("2026-07-04T00:00:00Z", True), ("2026-07-04T00:00:00", False)])
def test_offsets_have_minutes(spark, text, ok):
    got = spark.range(1).select(parse_iso_instant(F.lit(text)).isNotNull().alias("x")).first()["x"]
    assert got is ok


def test_a_corrupt_catalog_fails(spark, tmp_path):
    paths = jobs.Paths(str(tmp_path))
    assert jobs.current_catalog(spark, paths) is None
    (tmp_path / "catalog" / "_batch=0").mkdir(parents=True)
    (tmp_path / "catalog" / "_batch=0" / "part-0.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        jobs.current_catalog(spark, paths).collect()


def test_published_keys_carry_no_window(spark):
    row = dict(user_id="u", track_id="t", country="FR", count=21,
               window_start="2026-01-01T00:00:00Z", window_end="2026-01-01T00:05:00Z")
    df = spark.createDataFrame([row])
    alert = publish(df.select("user_id", "track_id", "count", "window_start", "window_end"),
                    "fraud_alerts").first()
    assert alert["key"] == "u|t"
    assert json.loads(alert["value"]) == {
        "userId": "u", "trackId": "t", "count": 21, "windowStart": row["window_start"],
        "windowEnd": row["window_end"]}
    assert publish(df, "skip_rate").first()["key"] == "t"
    assert publish(df, "top_by_country").first()["key"] == "FR|t"


def test_outputs_are_named_by_group():
    paths = jobs.Paths("/r", group="g", namespace="n")
    assert paths.out("skip_rate") == "/r/out/g.n.skiprate"
    assert jobs.Paths("/r").out("fraud_alerts") == f"/r/out/{C.DEFAULT_GROUP}.alerts.fraud"


def test_run_passes_its_options(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(jobs, "validated_schema", lambda raw: None)
    monkeypatch.setattr(jobs, "start_validation", lambda *a: None)
    monkeypatch.setattr(jobs, "valid_stream", lambda s, p, schema, max_files: max_files)
    for kind in ("skip_rate", "top", "royalties", "fraud"):
        monkeypatch.setattr(jobs, f"start_{kind}", lambda v, p, t, kind=kind, **o: seen.update(
            {kind: (v, o)}))
    jobs.run(spark, None, jobs.Paths("/r"), wait=False, fraud_window_minutes=60,
             dedup_ttl="7 days", max_files=3)
    assert seen == {"skip_rate": (3, {}), "top": (3, {}), "royalties": (3, {"dedup_ttl": "7 days"}),
                    "fraud": (3, {"window_minutes": 60})}


def test_dump_lines_keep_their_order(spark, tmp_path):
    track = lambda title: json.dumps({"track_id": "t", "title": title})
    lines = [{"key": "t", "value": track(f"v{i}"), "ts_ms": 9 - i % 3} for i in range(7)]
    text = "\n".join(json.dumps(x) for x in lines)
    text += "\n{'key': 't', 'value': '{}', 'ts_ms': 99}\n" + json.dumps(lines[0]) + " trailing\n"
    (tmp_path / "tracks.jsonl").write_text(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("64", old):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            recs = dump.read_dump(spark, str(tmp_path))
            assert recs.count() == 7
            latest = catalog.latest(dump.as_messages(recs)).collect()
            assert [r["title"] for r in latest] == ["v6"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_source_filters_and_columns_reach_the_scan(spark, tmp_path):
    from playlog.functions.validation import validate

    spark.sql("SELECT 1 AS partition, 5L AS offset, 'k' AS key, '{}' AS value, 'x' AS extra, "
              "'d' AS day").write.partitionBy("day").parquet(f"{tmp_path}/raw")
    raw = spark.read.parquet(f"{tmp_path}/raw")
    df = validate(raw, where="day = 'd' AND offset > 3", keep=["partition", "offset"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.split("\n") if "FileScan" in x)
    assert "isnotnull(day" in scan and "GreaterThan(offset,3)" in scan
    assert "ReadSchema: struct<partition:int,offset:bigint,value:string>" in scan
    assert df.columns[:2] == ["partition", "offset"] and df.count() == 1


def test_generated_methods_stay_compilable(spark):
    """The JVM stops compiling a method at 8000 bytes of code."""
    from playlog.functions.validation import validate

    raw = spark.createDataFrame([(0, 0, "k", "{}")], "partition int, offset long, key string, value string")
    plan = validate(raw)._jdf.queryExecution().executedPlan()
    codes = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(plan)
    sizes = [codes.apply(i)._3().maxMethodCodeSize() for i in range(codes.size())]
    assert sizes and max(sizes) < 7800


def test_late_queries_parse_once(spark):
    from playlog.plans import queries

    for name in ("late_filtered_skip_rate", "event_time_resolved"):
        plan = queries.registry()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution()
        assert "from_json" not in plan.optimizedPlan().toString()


def test_upsert_tables_keep_a_bounded_history(spark, tmp_path):
    from playlog.streaming.sinks import batches, read_table, upsert_batch

    path, want = f"{tmp_path}/t", {}
    write = upsert_batch(path, ["k"], every=4)
    for i in range(31):
        rows = [(i % 7, i), (100 + i, -i)] if i % 5 else []
        want.update(rows)
        write(spark.createDataFrame(rows, "k int, v int").coalesce(1), i)
        if i in (8, 20):  # a replayed batch changes nothing
            write(spark.createDataFrame(rows, "k int, v int").coalesce(1), i)
        ids, _ = batches(spark, path)
        assert len(ids) <= 9
    got = {r["k"]: r["v"] for r in read_table(spark, path, ["k"]).collect()}
    assert got == want
