"""Scale rehearsal: the whole batch job over the sf0.1 raw messages replicated N times
(event ids, keys, offsets and times shifted per copy), to see throughput once fixed
overheads amortise.  Writes the replicated input once to a scratch folder.

  python scripts/scale_rehearsal.py [copies] [scratch_dir]
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 20
    scratch = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="run-")
    from pyspark.sql import functions as F

    from playlog.plans import batch
    from playlog.session import local_session
    from playlog.sources import fixtures
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    raw = fixtures.raw_messages(spark, sf)
    span = raw.agg(F.max("offset")).first()[0] + 1
    rep = raw.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("c"))
    shifted = rep.select(
        "partition", (F.col("offset") + F.col("c") * span).alias("offset"),
        (F.col("broker_time") + F.make_dt_interval(F.col("c") * 2)).alias("broker_time"),
        F.concat("key", F.lit("-"), F.col("c").cast("string")).alias("key"),
        # each copy is a new day of listening: shift ids and the payload's date
        F.regexp_replace(F.regexp_replace("value", r'"ev-', F.concat(F.lit('"ev-'), F.col("c").cast("string"), F.lit("-"))),
                         r"2026-07-0", F.concat(F.lit("2026-0"), (F.col("c") % 9 + 1).cast("string"), F.lit("-0")))
        .alias("value"))
    src = f"{scratch}/raw"
    shifted.write.mode("overwrite").parquet(src)
    n = spark.read.parquet(src).count()
    runs = []
    for i in range(2):                       # first run includes JIT warm-up
        t0 = time.perf_counter()
        batch.run(spark, spark.read.parquet(src), fixtures.catalog_changelog(spark, sf),
                  f"{scratch}/out{i}")
        runs.append(time.perf_counter() - t0)
    print(json.dumps({"messages": n, "copies": copies,
                      "batch_job_sec": {"cold": round(runs[0], 2), "warm": round(runs[1], 2)},
                      "messages_per_sec": {"cold": round(n / runs[0], 1), "warm": round(n / runs[1], 1)}}))


if __name__ == "__main__":
    main()
