"""Registered queries of the operators and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (cuckoo_dedup, flow_mix, histogram_shard, imatch, kronecker_negatives, merkle_log, minmax_neardup, nce_language_model, secret_scan, suffix_repeats,
               template_extract, toxicity, window_pack)
from .common import table


def op1_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram_shard.histogram_shards(table(spark, sf_dir, "documents"), 24)


def op2_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template_extract.main_text(table(spark, sf_dir, "pages"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_neardup.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow_mix.mix_documents(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuckoo_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def tokenizer_files() -> dict[str, str]:
    import public_tokenizers
    return {"tokenizer_json": public_tokenizers.path("byte_bpe_50k.json"), "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
            "pattern": public_tokenizers.PATTERN}


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = window_pack.pack(table(spark, sf_dir, "documents"), **tokenizer_files())
    return packed.withColumn("ids_crc32", F.crc32("ids").cast("long")).drop("ids")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("removed")


def op10_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kronecker_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_log.verified_manifest(table(spark, sf_dir, "documents"))


def op13_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nce_language_model.language_scores(table(spark, sf_dir, "documents"))


QUERIES = {"op1_shard": op1_shard, "op2_extract": op2_extract, "op3_near_dedup": op3_near_dedup, "op4_mix": op4_mix, "op5_exact_dedup": op5_exact_dedup,
           "op6_pack": op6_pack, "op7_toxicity": op7_toxicity, "op8_secrets": op8_secrets,
           "op9_suffix_dedup": op9_suffix_dedup, "op10_imatch": op10_imatch, "op11_hard_negatives": op11_hard_negatives,
           "op12_merkle": op12_merkle, "op13_language_model": op13_language_model}
ORACLE = {"op3_near_dedup": minmax_neardup.ORACLE, "op4_mix": flow_mix.ORACLE, "op5_exact_dedup": cuckoo_dedup.ORACLE,
          "op11_hard_negatives": kronecker_negatives.ORACLE, "op12_merkle": merkle_log.ORACLE}
