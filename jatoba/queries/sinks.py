"""Sinks: written to a fresh folder, then read back whole."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jatoba.operators.sinks import export_csv, read_csv, replace_table, truncate_insert
from jatoba.queries.registry import plain_names, query, table
from jatoba.session import shared_dir
from jatoba.sources.tables import Lake


def _lake(spark: SparkSession) -> Lake:
    return Lake(spark, shared_dir(spark, "sink"), f"sink_{uuid.uuid4().hex}").create()


@query("""
SELECT o_orderkey AS id, o_orderstatus AS deal_stage_name, o_totalprice AS amount FROM orders
""")
def bronze_replace_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by one with another schema."""
    lake = _lake(spark)
    replace_table(table(spark, sf_dir, "nation"), lake, "bronze", "deals")
    deals = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("deal_stage.name"),
        F.col("o_totalprice").alias("amount"),
    )
    replace_table(deals, lake, "bronze", "deals")
    return plain_names(lake.read("bronze", "deals"))


@query("""
SELECT o_orderkey AS id, o_orderpriority AS name, o_orderdate AS created_at FROM orders
""")
def truncate_insert_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows replaced, columns by position: the target keeps its names and types."""
    lake, schema = _lake(spark), "id bigint, name string, created_at timestamp_ntz"
    orders = table(spark, sf_dir, "orders")
    first = orders.select("o_custkey", "o_orderstatus", "o_orderdate")
    truncate_insert(first, lake, "silver", "deals", schema)
    truncate_insert(orders.select("o_orderkey", "o_orderpriority", "o_orderdate"), lake, "silver", "deals", schema)
    return lake.read("silver", "deals")


@query("""
SELECT doc_id, text, CASE WHEN doc_id % 7 <> 0 THEN source END AS source, n_chars FROM documents
""")
def csv_export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with quotes, commas, accents and line breaks, and NULLs, to CSV and back."""
    path = shared_dir(spark, "csv")
    source = F.when(F.col("doc_id") % 7 != 0, F.col("source"))
    export_csv(table(spark, sf_dir, "documents").select("doc_id", "text", source.alias("source"), "n_chars"), path)
    return read_csv(spark, path, "doc_id bigint, text string, source string, n_chars bigint")
