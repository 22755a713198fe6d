"""The corpus pipeline: each stage calls one operator of `playlog.llm` on what the stage before
kept, and its decisions take effect.

1. quality_rules   documents that break a rule of the threshold table go
2. near_dedup      of each group of near copies (five-word shingles, similarity 0.8) the
                   document with the smallest id stays, once; of versions with that id the
                   one with the smallest digest
3. suffix_dedup    every passage of 100 bytes or more that also starts earlier is cut
4. secret_scan     owner-specific, live-looking credentials are replaced by a mark; base
                   spans that are widely copied examples stay
5. packing         documents are tokenised and packed into windows of 4096

Stages 1 to 4 return the columns of `documents` (doc_id, text, lang, source, n_chars);
n_chars is counted anew where the text changes.  A document left empty stays, with an empty
text.

A document is an id and a text.  Rows that share an id, or have none, but differ in their
texts are judged one by one and each kept one stays; a null id comes after all others, so a
row without one stays only if no near copy has an id.  Rows equal in id and text are one
document, with the smallest (lang, source, n_chars) among them.

Each stage's result is written as Parquet and read again, so a lost executor costs
at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlog.llm import near_dedup, packing, quality_rules, secret_scan, suffix_dedup
from playlog.llm.common import vocabulary
from playlog.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _named(docs: DataFrame) -> DataFrame:
    """`docs` with `name`, a digest of id and text that is never null."""
    return docs.select(*COLUMNS, F.md5(F.encode(F.concat_ws(
        ":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")),
        F.coalesce("text", F.lit(""))), "UTF-8")).alias("name"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    named = _named(docs)
    #: the verdict is on id and text; the struct's order names a component by its smallest id
    row = F.struct(F.col("doc_id").isNull().alias("none"),
                   F.coalesce("doc_id", F.lit(0)).alias("id"), "name")
    kept = near_dedup.near_dedup(named.select(row.alias("row"), "text"), key="row").where(
        "kept").select("row.name").distinct()
    once = named.groupBy("name").agg(F.min(F.struct(
        "doc_id", "lang", "source", "n_chars", "text")).alias("d"))
    return once.join(kept, "name", "left_semi").select("d.*").select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    #: as for near copies, rows without an id come last and are documents of their own
    own = F.when(F.col("doc_id").isNull(), F.xxhash64("text"))
    found = suffix_dedup.suffix_dedup(docs, carry=("lang", "source"), tie=own, nulls_last=True)
    return suffix_dedup.without_runs(found).select("doc_id", "text", "rest.*").withColumn(
        "n_chars", F.length("text").cast("long")).select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    named = _named(docs)
    #: rows of one name have the same spans
    spans = secret_scan.scan(named, key="name").select(
        "name", "spans").dropDuplicates(["name"])
    return named.join(spans, "name").withColumn(
        "text", secret_scan.redact(F.col("text"), F.col("spans"))).withColumn(
        "n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), end_id=2).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_copies),
    ("suffix_dedup", repeated_passages),
    ("secret_scan", secrets),
    ("packing", pack),
]

#: Packing's tokenisation, and near copies by whole sets, are beyond SQL of bearable length;
#: tests/llm hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, "pipeline", name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
