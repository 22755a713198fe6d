"""Driver contract: entry runs, every query has a DuckDB oracle (or says why not)."""

import __spark_entry__ as entry


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["track_id", "window_start", "window_end", "skips", "completes",
                          "total", "skip_rate", "flop"]


def test_every_query_has_an_oracle():
    from playlog.plans import oracle, queries
    assert set(queries.registry()) == set(oracle.oracle())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_no_query_uses_a_row_cap():
    import inspect
    from playlog.plans import queries, replay_queries, stream_queries
    for mod in (queries, replay_queries, stream_queries):
        src = inspect.getsource(mod)
        assert ".limit(" not in src and ".sample(" not in src


def test_kafka_shape(spark):
    import datetime as dt
    from playlog.sources.kafka import kafka_shape
    df = spark.createDataFrame(
        [(bytearray(b"u-1"), bytearray(b'{"a":1}'), "t", 3, 7, dt.datetime(2026, 7, 16), 0)],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int")
    row = kafka_shape(df).first()
    assert (row.key, row.value, row.partition, row.offset) == ("u-1", '{"a":1}', 3, 7)


def test_batch_job_writes_five_outputs(spark, tmp_path):
    from playlog import contract as C
    from playlog.plans import batch
    from playlog.sources import fixtures
    sf = "/root/testdata/sf0.001"
    out = batch.run(spark, fixtures.raw_messages(spark, sf), fixtures.catalog_changelog(spark, sf),
                    str(tmp_path / "out"), batch.BatchConfig(group="g7", late_rule=False))
    assert set(out) == {C.output_name(k, "g7") for k in C.OUTPUT_SUFFIXES}
    skip = spark.read.parquet(out["g7.skiprate"])
    from playlog.plans import queries as q
    assert sorted(skip.collect()) == sorted(q.skip_rate_q(spark, sf).collect())
    dlq = spark.read.parquet(out["g7.dlq"])
    assert dlq.count() == q.dlq_messages(spark, sf).count()


def test_cli_batch(spark, tmp_path):
    from playlog import cli
    from playlog.sources import fixtures
    sf = "/root/testdata/sf0.001"
    fixtures.raw_messages(spark, sf).write.parquet(str(tmp_path / "raw"))
    fixtures.catalog_changelog(spark, sf).write.parquet(str(tmp_path / "cat"))
    cli.main(["batch", "--events", str(tmp_path / "raw"), "--catalog", str(tmp_path / "cat"),
              "--out", str(tmp_path / "out"), "--group", "grp07"])
    assert spark.read.parquet(str(tmp_path / "out" / "grp07.royalties")).count() > 0
    assert spark.read.parquet(str(tmp_path / "out" / "grp07.dlq")).count() > 0


def test_rerun_replaces_staged_partitions(spark, tmp_path):
    from conftest import event, raw_frame
    from playlog.plans import batch
    staged = str(tmp_path / "staged")
    batch.stage_validated(raw_frame(spark, [event(), "poison"]), staged)
    assert batch.read_dead(spark, staged).count() == 1
    batch.stage_validated(raw_frame(spark, [event()]), staged)       # no dead letters now
    assert batch.read_dead(spark, staged).count() == 0
    assert batch.read_valid(spark, staged).count() == 1


def test_batch_job_late_rule_matches_operators(spark, tmp_path):
    from playlog import contract as C
    from playlog.operators import fraud, skip_rate, top_country
    from playlog.operators.catalog import lookup
    from playlog.plans import batch
    from playlog.plans import queries as q
    from playlog.sources import fixtures
    sf = "/root/testdata/sf0.001"
    raw, cl = fixtures.raw_messages(spark, sf), fixtures.catalog_changelog(spark, sf)
    out = batch.run(spark, raw, cl, str(tmp_path / "o"), batch.BatchConfig(group="g"))
    v = q.valid(spark, sf)
    want = {"g.skiprate": skip_rate.skip_rate(v, grace=C.SKIP_GRACE),
            "g.top.by-country": top_country.top_by_country(v, lookup(cl), grace=C.TOP_GRACE),
            "g.alerts.fraud": fraud.fraud_alerts(v, grace=C.FRAUD_GRACE)}
    for name, df in want.items():
        assert sorted(spark.read.parquet(out[name]).collect()) == sorted(df.collect()), name
