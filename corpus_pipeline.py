"""From raw documents to token ids: each stage works on all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from mendflow.llm import decontaminate, mixing, neardup, quality, token_output
from mendflow.llm.ship import ship
from mendflow.sources.tables import delete_folder, scratch, scratch_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.filter_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays."""
    ship(spark)
    return neardup.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    ship(spark)
    return decontaminate.remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source gets the same share of the characters; documents are repeated or left out."""
    return mixing.mix(docs).drop("copy", "order_key")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' place, length and checksum in the coded files, read back from them.

    The files keep the order in which mixing has written the documents.
    """
    ship(spark)
    folder = scratch_folder(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    token_output.write_token_ids(docs, folder, path, token_output.stored_order(docs))
    return token_output.read_token_ids(spark, folder)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("token_ids", token_ids),
]

#: SQL can't express minhashing, the latent space or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage is written as Parquet and read again by the next.

    What a stage has read goes, with its scratch, as soon as its own rows are written.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        folder = scratch_folder(spark)
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if before is not None:
            delete_folder(spark, before)
        before = folder
    return docs
