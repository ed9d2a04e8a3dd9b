"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.llm.decontamination import contamination
from silverlode.llm.hard_negatives import hard_negatives
from silverlode.llm.language_id import language_mixtures
from silverlode.llm.license_scan import license_scan
from silverlode.llm.line_dedup import drop_boilerplate
from silverlode.llm.merkle import fold, leaf_hash, manifest, proof_hash
from silverlode.llm.near_dedup import near_duplicates
from silverlode.llm.packing import pack
from silverlode.llm.quality_model import quality
from silverlode.llm.quality_rules import clean_lines
from silverlode.llm.sharding import contiguous_shards, text_size
from silverlode.llm.token_counts import token_counts
from silverlode.llm.toxicity import toxicity

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return drop_boilerplate(spark, pages)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    mixed = language_mixtures(spark, docs, keep_text=False)
    return mixed.select("doc_id", "held_out", "lang_pred", "score", F.size("languages")
                        .alias("n_languages"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination(spark, docs, _table(spark, sf_dir, "benchmark"), keep_text=False)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    scored = quality(spark, docs, _table(spark, sf_dir, "labels"), keep_text=False)
    return scored.select("doc_id", "held_out", "score", "predicted")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = clean_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "lost_chars",
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts(spark, docs, model, keep_text=False)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity(spark, docs, _table(spark, sf_dir, "labels"), keep_text=False)
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("segments")
                         .alias("n_segments"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(spark, docs, keep_text=False)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0

    def leaf(n_chars: Column) -> Column:
        return leaf_hash([F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")])

    leaves = docs.select("doc_id", "lang", leaf(F.col("n_chars")).alias("leaf"), F.when(
        hit, leaf(F.col("n_chars") + 1)).alias("tampered"))
    proved = manifest(spark, leaves, keep=["tampered"])
    folded = proved.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", proof_hash(F.col("path")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = _table(spark, sf_dir, "documents").select(
        "doc_id", text_size().alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
    )
    return contiguous_shards(spark, sized, order=["doc_id", "size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives(spark, vectors, is_anchor=F.col("vec_id") % 100 == 0)


def queries() -> dict[str, Query]:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_line_dedup": op1_line_dedup,
        "op2_language_id": op2_language_id,
        "op3_decontamination": op3_decontamination,
        "op4_quality_classifier": op4_quality_classifier,
        "op5_quality_rules": op5_quality_rules,
        "op6_license_scan": op6_license_scan,
        "op7_token_counts": op7_token_counts,
        "op8_toxicity": op8_toxicity,
        "op9_packing": op9_packing,
        "op10_minhash_near_dedup": op10_minhash_near_dedup,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_sharding": op12_sharding,
        "op13_hard_negatives": op13_hard_negatives,
    }
