"""Upsert tables with closed windows, and the catalog's versions."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from playlog.operators import top_country
from playlog.streaming import jobs
from playlog.streaming.sinks import batches, read_table, upsert_batch

ROWS = "track_id string, window_start string, window_end string, n int"


def _windows(b):
    """The windows that micro-batch b updates: the current hour's six and a late one."""
    start = dt.datetime(2026, 1, 1) + dt.timedelta(minutes=30 * b)
    out = []
    for i, back in enumerate([0, 0, 10, 20, 60, 170]):
        ws = start - dt.timedelta(minutes=back)
        ws -= dt.timedelta(minutes=ws.minute % 10)
        out.append((f"t{i}", f"{ws:%Y-%m-%dT%H:%M:%SZ}",
                    f"{ws + dt.timedelta(minutes=10):%Y-%m-%dT%H:%M:%SZ}", b))
    return out


def _size(path):
    return sum(f.stat().st_size for f in Path(path).rglob("*.parquet"))


def test_closed_windows_are_written_once(spark, tmp_path):
    """200 micro-batches over four days: what a batch writes does not grow with the table."""
    path, want, bytes_written = f"{tmp_path}/t", {}, {}
    write = upsert_batch(path, ["track_id", "window_start"], every=8, grace="3 hours")
    seen_final = {}
    for b in range(200):
        rows = _windows(b)
        want.update({r[:2]: r[2:] for r in rows})
        batch = spark.createDataFrame(rows, ROWS).coalesce(1)
        write(batch, b)
        if b in (24, 100, 101):     # replayed
            write(batch, b)
        bytes_written[b] = _size(f"{path}/_batch={b}") + _size(f"{path}/_closed/_batch={b}")
        if b % 40 == 39:
            now = {str(f): f.stat().st_mtime_ns for f in Path(path, "_closed").rglob("*.parquet")}
            assert seen_final.items() <= now.items()        # final files never change
            seen_final = now
    assert len(batches(spark, path)[0]) <= 17
    whole = {b: n for b, n in bytes_written.items() if b and b % 8 == 0}
    early, late = [n for b, n in whole.items() if 24 <= b < 64], [n for b, n in whole.items() if b >= 160]
    assert max(late) <= 1.5 * max(early)
    got = {(r["track_id"], r["window_start"]): (r["window_end"], r["n"])
           for r in read_table(spark, path, ["track_id", "window_start"]).collect()}
    assert got == want
    days = {p.name for p in Path(path, "_closed").rglob("_day=*")}
    assert {"_day=2026-01-01", "_day=2026-01-04"} <= days


@pytest.mark.parametrize("every", [3, 100])
def test_windows_stay_open_for_the_grace(spark, tmp_path, every):
    """A window is not closed by the newest batches, whose watermark may not hold yet."""
    path = f"{tmp_path}/t"
    write = upsert_batch(path, ["track_id", "window_start"], every=every, grace="1 hour")
    early = ("t", "2026-01-01T00:00:00Z", "2026-01-01T00:10:00Z")
    for b, rows in enumerate([[(*early, 1)], [("t", "2026-01-01T05:00:00Z", "2026-01-01T05:10:00Z", 1)],
                              [(*early, 2)], [(*early, 3)], [(*early, 4)]]):
        write(spark.createDataFrame(rows, ROWS), b)
    got = {r["window_start"]: r["n"] for r in read_table(spark, path, ["track_id", "window_start"]).collect()}
    assert got["2026-01-01T05:00:00Z"] == 1 and (every == 3 or got["2026-01-01T00:00:00Z"] == 4)


def test_the_catalog_is_read_once_a_version(spark, tmp_path, monkeypatch):
    reads = []
    real = jobs.read_table
    monkeypatch.setattr(jobs, "read_table", lambda *a: reads.append(1) or real(*a))
    paths = jobs.Paths(str(tmp_path))
    side = jobs.CatalogSide(paths)
    counts = spark.createDataFrame([("FR", "t1", 1), ("FR", "t2", 1)], "country string, track_id string, listens long"
                                   ).withColumn("window", F.struct(F.timestamp_seconds(F.lit(0)).alias("start"),
                                                                   F.timestamp_seconds(F.lit(900)).alias("end")))

    def titles():
        return {r["track_id"]: r["title"] for r in top_country.enrich(counts, side(spark)).collect()}

    assert titles() == {"t1": None, "t2": None} and not reads
    _write_version(spark, paths, 0, [("t1", "one")])
    assert [titles() for _ in range(5)] == [{"t1": "one", "t2": None}] * 5 and len(reads) == 1
    _write_version(spark, paths, 1, [("t2", "two")])
    assert [titles() for _ in range(5)] == [{"t1": "one", "t2": "two"}] * 5 and len(reads) == 2
    assert jobs.catalog_version(spark, paths)[0] == 1
    assert jobs.catalog_version(spark, paths)[1] > jobs.catalog_version(spark, paths, 1)[1] > 0


def _write_version(spark, paths, batch_id, tracks):
    """What a micro-batch of the catalog query does."""
    rows = [(k, False, k, title, "a", "g", 1) for k, title in tracks]
    jobs.catalog_batch(paths)(spark.createDataFrame(
        rows, "key string, deleted boolean, track_id string, title string, artist string, "
        "genre string, duration_ms int"), batch_id)


def test_the_bound_of_the_catalog_decides_the_join(spark, tmp_path):
    paths = jobs.Paths(str(tmp_path))
    _write_version(spark, paths, 0, [("t1", "x" * 1000)])
    spark.conf.set("spark.playlog.broadcastLimitBytes", "500")
    try:
        hint = jobs.CatalogSide(paths)(spark)._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.unset("spark.playlog.broadcastLimitBytes")
    assert "strategy=merge" in hint
    assert "strategy=broadcast" in jobs.CatalogSide(paths)(spark)._jdf.queryExecution().analyzed().toString()
