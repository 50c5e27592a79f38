"""From documents to training sequences: five stages, each written as Parquet and read again.

1. ``language_id``: documents of no language go.
2. ``simhash_near_dedup``: one document of each group of near copies stays.
3. ``substring_dedup``: passages that an earlier document holds are cut out.
4. ``source_mixing``: documents are repeated or left out so that the sources meet their shares.
5. ``packing``: documents become sequences of power-of-two length, with their ids.

Every stage but the last returns the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jatoba.llm import language, mixing, packing, simhash, substrings
from jatoba.llm.queries import default_tokenizer
from jatoba.llm.session import prepare
from jatoba.session import delete_folder, shared_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language that can be told stay; NULL, blank and letterless texts go. Repeats and ties: as :func:`language.predict`."""
    prepare(spark)
    return language.keep_identified(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints lie within two bits of each other, also by way of others, the smallest doc_id stays."""
    prepare(spark)
    return simhash.keep_one(docs, words=3, threshold=2)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut out; a document of which nothing is left stays with what is left."""
    prepare(spark)
    return substrings.cut_passages(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out until each source comes near its target; rows without source are a source."""
    prepare(spark)
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two length; a NULL or empty text is the end id alone, a long text many sequences."""
    prepare(spark)
    return packing.pack(docs, default_tokenizer())


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("source_mixing", source_mixing),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``. A stage's copy in the shared folder goes when the next one is written,
    or when a stage fails; the last one stays for the reader of the result."""
    prepare(spark)
    docs, kept = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, function in STAGES:
        path = shared_dir(spark, name)
        try:
            made = function(spark, docs, sf_dir)
            made.write.parquet(path)
        except Exception:
            delete_folder(spark, path)
            raise
        finally:
            if kept:
                delete_folder(spark, kept)
        docs, kept = spark.read.schema(made.schema).parquet(path), path
    return docs
