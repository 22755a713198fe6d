"""The operators' queries: each applies one operator, with production parameters, to its
whole table and derives the contract's columns from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlog.llm import (
    byte_bpe,
    exact_dedup,
    fingerprints,
    hard_negatives,
    license_scan,
    near_dedup,
    packing,
    quality_rules,
    ranked_search,
    secret_scan,
    suffix_dedup,
    token_counts,
    toxicity,
)
from playlog.llm.common import vocabulary


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), end_id=2)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(documents(spark, sf_dir), words=4)


def op3_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(
        documents(spark, sf_dir), license_scan.known(spark)).withColumn(
        "notices", F.array_join("notices", ","))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != secret_scan.OPAQUE)
    return secret_scan.scan(documents(spark, sf_dir)).select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"), F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.suffix_dedup(documents(spark, sf_dir))
    return suffix_dedup.without_runs(found).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = toxicity.train(docs, labels.select("doc_id", "toxic"), ~held_out)
    return toxicity.toxicity(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.chained(documents(spark, sf_dir)).select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited", "near_next")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = vocabulary("byte_bpe_50k.tiktoken"), byte_bpe.pattern()
    return byte_bpe.encode(documents(spark, sf_dir), ranks, pattern, round_trip=True).select(
        "doc_id", F.expr("length(ids) DIV 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("raw", 256).alias("decoded_sha256"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0,
                               key="vec_id", positives=5, negatives=3, low=50, high=95)


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a stream takes a folder or a pattern: this one matches the table's name alone
    return exact_dedup.exact_dedup(spark, f"{sf_dir}/documents.parque[t]").select(
        F.col("key").alias("doc_id"), F.col("keep_key").alias("keep_id"), "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return ranked_search.search(documents(spark, sf_dir), items, k=50)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": op1_packing,
        "op2_near_dedup": op2_near_dedup,
        "op3_license_digests": op3_license_digests,
        "op4_secret_scan": op4_secret_scan,
        "op5_quality_rules": op5_quality_rules,
        "op6_suffix_dedup": op6_suffix_dedup,
        "op7_token_counts": op7_token_counts,
        "op8_toxicity": op8_toxicity,
        "op9_fingerprints": op9_fingerprints,
        "op10_byte_bpe": op10_byte_bpe,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_exact_dedup": op12_exact_dedup,
        "op13_ranked_search": op13_ranked_search,
        "pipeline": pipeline,
    }


def oracle() -> dict[str, str]:
    from playlog.llm import oracle

    return oracle.oracle()
