"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed in full into Spark's ``noop`` sink (every row computed, nothing
collected to the driver), once to warm up and then three times; the median counts.  Plans are
built anew each time and the size check of the catalog is part of the queries that need it.
The one small input file is dealt to as many partitions as there are cores.  ``batch_job`` is the whole job
(parse once into a staged table, then the five outputs written as parquet);
``stream_job`` is the streaming layout (validation query, catalog query, four stateful
queries with watermarks and upsert sinks) draining the same input with ``availableNow``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["validated_events", "dlq_messages", "skip_rate", "top_by_country", "royalties",
            "fraud_alerts", "late_filtered_skip_rate", "late_filtered_top", "catalog_latest",
            "event_time_resolved", "dump_timeline"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from playlog.plans import batch
    from playlog.plans import queries as q
    from playlog.session import local_session, scratch_path
    from playlog.sources import fixtures

    spark = local_session(cpus, shuffle_partitions=max(4, 2 * int(cpus)), app="playlog-bench")
    spark.conf.set("spark.playlog.inputPartitions", cpus)
    reg = q.registry()

    def run(name):
        t0 = time.perf_counter()
        reg[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    times = {}
    for name in HEADLINE:
        run(name)
        times[name] = round(statistics.median(run(name) for _ in range(3)), 3)

    t0 = time.perf_counter()
    batch.run(spark, fixtures.raw_messages(spark, sf_dir), fixtures.catalog_changelog(spark, sf_dir),
              scratch_path(spark, "bench"))
    times["batch_job"] = round(time.perf_counter() - t0, 3)

    from playlog.plans import stream_queries
    from playlog.streaming import jobs
    t0 = time.perf_counter()
    paths = jobs.Paths(scratch_path(spark, "bench-stream"))
    jobs.run(spark, fixtures.raw_messages_from(fixtures.events_stream(spark, sf_dir)), paths,
             stream_queries._catalog_stream(spark, sf_dir))
    times["stream_job"] = round(time.perf_counter() - t0, 3)

    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir).removeprefix("sf"),
                      "events": events, "cpus": int(cpus),
                      "batch_job_events_per_sec": round(events / times["batch_job"], 1),
                      "stream_job_events_per_sec": round(events / times["stream_job"], 1)}))
    spark.stop()


if __name__ == "__main__":
    main()
