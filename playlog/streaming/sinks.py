"""Output sinks (K1-K6).

* Keyed outputs (skip rate, top, royalties, fraud, catalog) are changelogs: update
  mode emits the new value of every key touched by a micro-batch.  ``upsert_batch``
  writes each micro-batch to its own ``_batch=<id>`` folder, so a batch replayed after a
  failure replaces its own files (idempotent), and every so often a batch holds the whole
  state; ``read_table`` takes the newest row per key (``max_by`` over the batch id) from
  there on: the table's current state.  Rows of windows that the watermark has passed are
  final: they move once to folders by window day, which are never written again, so what
  a batch writes is bounded by the open windows, not by the table's age.
* The dead-letter output is append-only (exactly-once through the file sink's log).
* ``publish`` shapes a keyed output as the contract's records; ``to_kafka`` any output as Kafka ``key``/``value`` text for the Kafka sink
  (the connector jar is not bundled here; the shaping is plain columns).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlog import contract as C
from playlog.functions.jsonparse import to_json_text

BATCH_COL = "_batch"
BASE_MARK = "_whole_state"
COMPACT_EVERY = 32
CLOSED, DAY = "_closed", "_day"


def folder(spark: SparkSession, path: str):
    """A path and its file system."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark._jsc.hadoopConfiguration())


def numbered(spark: SparkSession, path: str) -> list[int]:
    """The files of a folder whose names are numbers, ascending."""
    root, fs = folder(spark, path)
    names = [f.getPath().getName() for f in fs.listStatus(root)] if fs.exists(root) else []
    return sorted(int(n) for n in names if n.isdigit())


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file in one go: it appears under its name when it is complete."""
    target, fs = folder(spark, path)
    part, _ = folder(spark, f"{path}.part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(target, False)
    if not fs.rename(part, target):
        raise OSError(f"{path} could not be written")


def get_text(spark: SparkSession, path: str) -> str:
    target, fs = folder(spark, path)
    source = fs.open(target)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def batches(spark: SparkSession, path: str) -> tuple[list[int], list[int]]:
    """(ids of the batches of an upsert table, those among them that hold the whole state),
    both ascending; empty if nothing was written yet."""
    root, fs = folder(spark, path)
    if not fs.exists(root):
        return [], []
    ids, full = [], []
    for f in fs.listStatus(root):
        name = f.getPath().getName()
        if name.startswith(f"{BATCH_COL}="):
            i = int(name.removeprefix(f"{BATCH_COL}="))
            ids.append(i)
            if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), BASE_MARK)):
                full.append(i)
    return sorted(ids), sorted(full)


def _read(spark: SparkSession, path: str, ids: Sequence[int]) -> DataFrame:
    return spark.read.option("basePath", path).parquet(*[f"{path}/{BATCH_COL}={i}" for i in ids])


def _newest(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    values = [c for c in df.columns if c not in keys and c != BATCH_COL]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col(BATCH_COL)).alias("_v"))
    return newest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])


def _instant(c: str):
    return F.col(c).cast("timestamp")


def upsert_batch(path: str, keys: Sequence[str] | None = None, every: int = COMPACT_EVERY,
                 grace: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function writing one folder per micro-batch; a replayed batch
    replaces its own.

    Each ``every``-th batch writes the whole state (its rows merged into the newest state
    before it) and marks it; readers start at the newest mark.  What lies before the mark
    before that goes, so a reader that has just listed the folders keeps its files for
    ``every`` batches, and a table has at most 2 * ``every`` + 1 folders.  Without ``keys``
    there is no state to merge and every batch stays.

    ``grace`` (the query's watermark delay) is for tables with ``window_start`` and
    ``window_end``.  A row of an earlier batch tells that its watermark is not before its
    window's start less the grace; windows that ended by then get no more updates, and leave the
    state for ``_closed/_batch=<id>/_day=<window day>``.
    """
    path = path.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ids, full = batches(spark, path)
        ids, full = [i for i in ids if i < batch_id], [i for i in full if i < batch_id]
        leaf = f"{path}/{BATCH_COL}={batch_id}"
        if keys is None or not ids or batch_id % every:
            batch.write.mode("overwrite").parquet(leaf)
            return
        since = _read(spark, path, [i for i in ids if not full or i >= full[-1]])
        state = _newest(since.unionByName(batch.withColumn(BATCH_COL, F.lit(batch_id))), keys)
        if grace:
            # merged once, then split; the micro-batch itself is read only once
            merged, fs = folder(spark, f"{path}/_merged/{batch_id}")
            state.write.mode("overwrite").parquet(str(merged))
            state = spark.read.schema(batch.schema).parquet(str(merged))
            settled = since.where(F.col(BATCH_COL) <= batch_id - 2).agg(F.unix_micros(
                F.max(_instant("window_start")) - F.expr(f"INTERVAL {grace}")).alias("h")).first()["h"]
            done = F.coalesce(F.unix_micros(_instant("window_end")) <= F.lit(settled), F.lit(False))
            (state.where(done).withColumn(DAY, F.substring("window_start", 1, 10)).write
             .mode("overwrite").partitionBy(DAY).parquet(f"{path}/{CLOSED}/{BATCH_COL}={batch_id}"))
            state.where(~done).write.mode("overwrite").parquet(leaf)
            fs.delete(merged, True)
        else:
            state.write.mode("overwrite").parquet(leaf)
        mark, fs = folder(spark, f"{leaf}/{BASE_MARK}")
        fs.create(mark).close()
        for i in [i for i in ids if full and i < full[-1]]:
            old, fs = folder(spark, f"{path}/{BATCH_COL}={i}")
            fs.delete(old, True)
    return write


def read_closed(spark: SparkSession, path: str, until: int, schema: T.StructType) -> DataFrame | None:
    """The final rows that batches up to ``until`` moved, with their window day as ``_day``."""
    ids = [i for i in batches(spark, f"{path}/{CLOSED}")[0] if i <= until]
    if not ids:
        return None
    whole = T.StructType([*schema.fields, T.StructField(BATCH_COL, T.IntegerType()),
                          T.StructField(DAY, T.StringType())])
    return (spark.read.schema(whole).option("basePath", f"{path}/{CLOSED}")
            .parquet(*[f"{path}/{CLOSED}/{BATCH_COL}={i}" for i in ids]).drop(BATCH_COL))


def read_table(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Current state of an upserted table: the newest row of every key since the newest
    batch that holds the whole state, and the rows that were final by then."""
    path = path.rstrip("/")
    ids, full = batches(spark, path)
    state = _newest(_read(spark, path, [i for i in ids if not full or i >= full[-1]]), keys)
    closed = read_closed(spark, path, full[-1], state.schema) if full else None
    return state if closed is None else state.unionByName(closed.drop(DAY))


def to_kafka(df: DataFrame, key_cols: Sequence[str], sep: str = "|") -> DataFrame:
    """K2-K6 shaping: ``key`` = key columns joined by ``sep``, ``value`` = JSON row."""
    key = F.concat_ws(sep, *[F.col(c).cast("string") for c in key_cols])
    return df.select(key.alias("key"), to_json_text(*[F.col(c) for c in df.columns]).alias("value"))


def publish(df: DataFrame, kind: str) -> DataFrame:
    """Records of a keyed output as the contract publishes them: the key carries no window
    (the window is in the value), alerts have their own field names."""
    names = C.PUBLISH_NAMES.get(kind, {})
    key = F.concat_ws(C.KEY_SEPARATOR, *[F.col(c) for c in C.PUBLISH_KEYS[kind]])
    value = to_json_text(*[F.col(c).alias(names.get(c, c)) for c in df.columns])
    return df.select(key.alias("key"), value.alias("value"))
