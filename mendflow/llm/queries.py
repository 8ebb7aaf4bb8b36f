"""Registered queries of the corpus operators, and the SQL that checks those SQL can express."""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mendflow.llm import (
    alignment,
    chat,
    decontaminate,
    html_text,
    lines,
    mixing,
    neardup,
    prefix_trie,
    quality,
    substrings,
    token_output,
    urls,
    vectors,
)
from mendflow.llm.ship import ship
from mendflow.sources.tables import scratch_folder

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(fn):
        @functools.wraps(fn)
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = shipped
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return shipped

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.classify(table(spark, sf_dir, "documents"))


@query(chat.ORACLE)
def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame(
        [(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, sf_dir, "conversations").select(*added.columns)
    return chat.digest(rows.unionByName(added))


@query(urls.ORACLE)
def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.filter_urls(pages, urls.ALLOW, urls.BLOCK).drop("url")


@query(quality.ORACLE)
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).drop("host", "digest", "gone_lines")


@query()
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classify(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


@query(mixing.ORACLE.format(docs="documents"))
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query()
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query()
def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    token_output.write_token_ids(table(spark, sf_dir, "documents"), folder, path)
    return token_output.read_token_ids(spark, folder)


@query(vectors.ORACLE)
def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.classify(table(spark, sf_dir, "embeddings"))


@query(prefix_trie.ORACLE)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


@query()
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(table(spark, sf_dir, "documents"), *paths)
