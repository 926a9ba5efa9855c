"""Corpus pipeline: toxicity, exact dedup, near dedup, mixing to target weights, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's docs. All but the last return the columns of ``docs``. A row of docs is a document of its own: ids may be null
or repeat, texts may be null, extra columns are carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from courtline.llm import cuckoo_dedup, flow_mix, minmax_neardup, toxicity, window_pack
from courtline.llm.common import staged, table
from courtline.llm.queries import tokenizer_files


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold; the lexicon is learned from the labelled ones."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the document with the largest id stays, once."""
    return cuckoo_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents (5-word shingles, similarity 0.8 or more) the one with the smallest id stays, once."""
    return minmax_neardup.keep_one(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: whole repeats, the one that is taken in part if it is half or more."""
    return flow_mix.keep_taken(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences, with the checksum of their ids."""
    packed = window_pack.pack(docs, **tokenizer_files())
    return packed.withColumn("ids_crc32", F.crc32("ids").cast("long")).drop("ids")


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_exact_copies), ("near dedup", drop_near_copies),
          ("mixing", mix_sources), ("packing", pack_windows)]

#: The toxicity curve and the tokenizer can't be expressed in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
