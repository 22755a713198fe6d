"""Command line: run the whole job in batch or as streams.

  python -m playlog.cli batch  --events <parquet|jsonl dir> --catalog <...> --out <dir>
  python -m playlog.cli stream --bootstrap host:9092 --events-topic T --catalog-topic C --out <dir>
  python -m playlog.cli stream --dump-events <dir> --dump-catalog <dir> --out <dir>

Batch inputs are Kafka-shaped tables (partition, offset, broker_time, key, value) in
parquet, or recorded-dump folders (``--dump``).  Outputs are named
``<group>.[<namespace>.]<suffix>``; checkpoints live under the output folder.
"""

from __future__ import annotations

import argparse

from playlog import contract as C
from playlog.session import prepare


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="playlog")
    sub = ap.add_subparsers(dest="mode", required=True)
    b = sub.add_parser("batch")
    b.add_argument("--events", required=True)
    b.add_argument("--catalog", required=True)
    b.add_argument("--dump", action="store_true", help="inputs are recorded-dump folders")
    b.add_argument("--no-late-rule", action="store_true")
    s = sub.add_parser("stream")
    s.add_argument("--bootstrap", help="Kafka bootstrap servers (or use --dump-*)")
    s.add_argument("--events-topic")
    s.add_argument("--catalog-topic")
    s.add_argument("--dump-events", help="recorded-dump folder streamed as the event topic")
    s.add_argument("--dump-catalog", help="recorded-dump folder streamed as the catalog")
    s.add_argument("--every", default="10 seconds")
    s.add_argument("--min-partitions", type=int, default=None,
                   help="Kafka minPartitions for the event topic (default: the cluster's "
                        "parallelism, so a 6-partition topic is not parsed by 6 tasks)")
    s.add_argument("--state-partitions", type=int, default=None,
                   help="state / shuffle partitions of the stateful queries")
    s.add_argument("--max-offsets-per-trigger", type=int, default=None,
                   help="bound of a micro-batch read from either Kafka topic, in records")
    s.add_argument("--max-files-per-trigger", type=int, default=None,
                   help="bound of a micro-batch read from dumps (default: one file, so that "
                        "files follow each other) or the validated table")
    s.add_argument("--dedup-ttl", default=None,
                   help="bound the royalty de-duplication state, e.g. '7 days'")
    s.add_argument("--to-kafka", action="store_true",
                   help="publish outputs to Kafka topics <group>.[<namespace>.]<suffix>")
    for p in (b, s):
        p.add_argument("--out", required=True)
        p.add_argument("--group", default=C.DEFAULT_GROUP)
        p.add_argument("--namespace", default="")
        p.add_argument("--fraud-window-minutes", type=int, default=C.FRAUD_WINDOW_MINUTES)
    a = ap.parse_args(argv)

    from pyspark.sql import SparkSession
    spark = prepare(SparkSession.builder.appName("playlog").getOrCreate())
    if a.mode == "batch":
        from playlog.plans import batch
        if a.dump:
            from playlog.sources import dump
            raw = dump.as_messages(dump.read_dump(spark, a.events))
            changelog = dump.as_messages(dump.read_dump(spark, a.catalog))
        else:
            raw, changelog = spark.read.parquet(a.events), spark.read.parquet(a.catalog)
        cfg = batch.BatchConfig(a.group, a.namespace, not a.no_late_rule, a.fraud_window_minutes)
        for name, path in batch.run(spark, raw, changelog, a.out, cfg).items():
            print(name, path)
    else:
        from playlog.sources import kafka
        from playlog.streaming import dumps, jobs
        trigger = jobs.Trigger(available_now=False, every=a.every, state_partitions=a.state_partitions)
        if a.dump_events:
            def messages(folder, name):
                return dumps.start_messages(spark, folder, f"{a.out.rstrip('/')}/_dumps/{name}", trigger,
                                            a.max_files_per_trigger or 1)[1]
            raw = messages(a.dump_events, "events")
            changelog = messages(a.dump_catalog, "catalog") if a.dump_catalog else None
        else:
            min_parts = a.min_partitions or spark.sparkContext.defaultParallelism
            raw = kafka.read_topic(spark, a.bootstrap, a.events_topic, min_partitions=min_parts,
                                   max_offsets_per_trigger=a.max_offsets_per_trigger)
            changelog = kafka.read_topic(spark, a.bootstrap, a.catalog_topic,
                                         max_offsets_per_trigger=a.max_offsets_per_trigger)
        paths = jobs.Paths(a.out, group=a.group, namespace=a.namespace)
        if a.to_kafka:
            paths.kafka = jobs.KafkaOut(a.bootstrap, a.group, a.namespace)
        queries = jobs.run(spark, raw, paths, changelog, trigger, wait=False,
                           fraud_window_minutes=a.fraud_window_minutes,
                           dedup_ttl=a.dedup_ttl, max_files=a.max_files_per_trigger)
        for q in queries:
            print("started", q.name or q.id)
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
