"""The whole job in batch: raw messages in, the five outputs out.

1. One pass parses and validates every message and writes a staged table partitioned
   by ``status`` (``valid`` / ``dead_letter``): the JSON is parsed once, and each later
   stage reads only its partition (partition pruning) and only its columns.  The staged
   table in the shared folder also cuts the lineage: a lost executor recomputes from it,
   not from the raw source.
2. The dead-letter partition is the DLQ output (key, original, reason, JSON value).
3. Skip rate, top by country (with the catalog), royalties and fraud alerts each read
   the valid partition and write their output ``<group>.[<namespace>.]<suffix>``.

With ``late_rule`` the reference's graces apply (an event updates a window only while
``window_end > stream_time - grace``, stream time per source partition in offset
order); without it every valid event counts.  The rule reads four columns of the valid
partition once more per windowed output for the windows' closing positions; no event is
sorted or shuffled for it (``operators.windows.late_windows``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlog import contract as C
from playlog.operators import catalog, fraud, royalties, skip_rate, top_country
from playlog.session import prepare
from playlog.streaming.jobs import STATUS_DEAD, STATUS_VALID, validated_table


@dataclass
class BatchConfig:
    group: str = C.DEFAULT_GROUP
    namespace: str = ""
    late_rule: bool = True
    fraud_window_minutes: int = C.FRAUD_WINDOW_MINUTES
    output_format: str = "parquet"


def stage_validated(raw: DataFrame, path: str) -> None:
    validated_table(raw).write.mode("overwrite").partitionBy("status").parquet(path)


def read_valid(spark: SparkSession, path: str) -> DataFrame:
    t = spark.read.parquet(path)
    return t.filter(F.col("status") == STATUS_VALID).drop(
        "status", "reason", "original", "dlq_value", "key")


def read_dead(spark: SparkSession, path: str) -> DataFrame:
    t = spark.read.parquet(path)
    return t.filter(F.col("status") == STATUS_DEAD).select(
        "partition", "offset", "key", "original", "reason", "dlq_value")


def outputs(valid: DataFrame, changelog: DataFrame, cfg: BatchConfig) -> dict[str, DataFrame]:
    """The four keyed outputs."""
    g = (lambda grace: grace) if cfg.late_rule else (lambda grace: None)
    side = catalog.lookup(changelog)
    return {
        "skip_rate": skip_rate.skip_rate(valid, grace=g(C.SKIP_GRACE)),
        "top_by_country": top_country.top_by_country(valid, side, grace=g(C.TOP_GRACE)),
        "royalties": royalties.royalties(valid),
        "fraud_alerts": fraud.fraud_alerts(valid, cfg.fraud_window_minutes,
                                           grace=g(C.FRAUD_GRACE)),
    }


def run(spark: SparkSession, raw: DataFrame, changelog: DataFrame, out_root: str,
        cfg: BatchConfig = BatchConfig()) -> dict[str, str]:
    """Run everything; returns output name → path."""
    prepare(spark)
    root = out_root.rstrip("/")
    staged = f"{root}/_staged/validated"
    stage_validated(raw, staged)
    written = {}
    dlq_name = C.output_name("dlq", cfg.group, cfg.namespace)
    read_dead(spark, staged).write.mode("overwrite").format(cfg.output_format).save(f"{root}/{dlq_name}")
    written[dlq_name] = f"{root}/{dlq_name}"
    valid = read_valid(spark, staged)
    for kind, df in outputs(valid, changelog, cfg).items():
        name = C.output_name(kind, cfg.group, cfg.namespace)
        df.write.mode("overwrite").format(cfg.output_format).save(f"{root}/{name}")
        written[name] = f"{root}/{name}"
    return written
