"""Session helpers: the settings every job relies on, and the shared checkpoint folder.

Jobs never build their own session on a cluster; they take the caller's and only
check the few settings correctness depends on (UTC session zone).  ``local_session``
is for tests, the bench and the smoke entry.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the results depend on (window alignment and ISO text are UTC).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Settings for throughput; safe at any scale.
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "playlog") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    parts = shuffle_partitions or (8 if cpus == "*" else max(2, int(cpus)))
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(parts))
               .config("spark.driver.memory", os.environ.get("PLAYLOG_DRIVER_MEMORY", "8g")))
    for k, v in {**REQUIRED_CONF, **TUNING_CONF}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on; called by every public job."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Without that setting a cluster has no folder that every executor sees, so this
    raises.  Only a ``local`` session (tests, bench), where driver and executors are one
    process, falls back to a private temporary folder, kept for the whole session.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder shared by the driver "
                             "and all executors")
        root = tempfile.mkdtemp(prefix="playlog-ckpt-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return "/".join([checkpoint_root(spark), "playlog", *parts, uuid.uuid4().hex])


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint root and read it back: computed once however
    often it is used, and a lost executor re-reads it."""
    path = scratch_path(df.sparkSession, "staged", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
