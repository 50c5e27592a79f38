"""The registered queries of the numbered operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jatoba.llm import bpe, embeddings, language, licenses, merkle, mixing, neighbours, packing, quotes, repair, scoring, simhash, substrings
from jatoba.llm.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(function):
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@_query("op2_language_crf")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@_query("op6_simhash_anchors")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


@_query("op8_source_mix", mixing.SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"), whole=False)
    return found.select("doc_id", "size", "source_size", "target", "taken")


@_query("op9_compact_windows")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.find_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "length", "source_id", "source_start", F.round("similarity", 6).alias("similarity"))


@_query("op10_power_of_two_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), default_tokenizer(), with_ids=False)


@_query("op4_product_quantisation")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


@_query("op7_learned_partitions")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@_query("op1_license_sentences", licenses.SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.recognise(table(spark, sf_dir, "documents"))


@_query("op3_quotation_links")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.in_reply_order(quotes.link(table(spark, sf_dir, "conversations")))


@_query("op5_stupid_backoff", scoring.SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scoring.score(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", F.round("log_score", 3).alias("log_score"))


@_query("op11_merkle_multiproof", merkle.SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.check_documents(table(spark, sf_dir, "documents"))


@_query("op13_conversation_repair")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_damaged(table(spark, sf_dir, "conversations"))


@_query("op12_byte_level_bpe")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
