"""Landed API pages.

Two layouts hold the same thing, one response per page number:

* page files: ``<collection>/page=<n>.json``, or files of any name in ``<collection>/page=<n>/``, as
  Spark writes them, plus an optional ``<collection>_status.csv``;
* a page log: a table ``page, status, body`` with many pages per file. This is the one
  to use at scale, because millions of small files cost more to list than to read. A
  page may be spread over several rows of the log. A fourth column ``records`` may give
  the number of records in the body, as counted when the page arrived; then the bodies
  are read once and not twice.

Paging stops after the first page with fewer than ``limit`` records and before the
first page that did not answer 200. Both bounds come from one aggregate whose single
value enters the scan as a scalar subquery: no driver loop, no join. Up to that bound the
pages must be whole: a page without its envelope, a NULL body or count, a NULL status or
a page number that is missing stops the load instead of cutting the export short. Page 1
must be there and have answered 200: an export that failed altogether is an error and not
an empty one. An export whose first page holds no records is empty.

A log whose page numbers leave some out by nature, as those worked out from keys do, is read
with ``whole=False``: a number without a page is then no gap, and the first page may have any number.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jatoba.schemas import PAGE_LIMIT

_STRICT_JSON = {"mode": "FAILFAST"}
PAGES_IN_BLOCK = 1024
"""Pages whose numbers are looked at together when gaps are sought."""
NO_FIRST_PAGE = "page 1 is missing or did not answer 200"


def read_page_files(spark: SparkSession, landing: str, collection: str) -> tuple[DataFrame, DataFrame]:
    """Pages (``page, body``) and answers (``page, status``) of one collection."""
    number = F.regexp_extract("_metadata.file_path", r"/page=(\d+)(?:\.json|/[^/]+)$", 1)
    pages = (
        spark.read.option("recursiveFileLookup", "true").text(f"{landing}/{collection}", wholetext=True)
        .select(F.nullif(number, F.lit("")).cast("int").alias("page"), F.col("value").alias("body"))
        .where("page is not null")
    )
    schema = "page int, status int"
    try:
        path = f"{landing}/{collection}_status.csv"
        answers = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        answers = spark.range(0).selectExpr("cast(id as int) page", "200 status")
    return pages, answers


def read_page_log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Pages (``page, body`` and maybe ``records``) and answers from a Parquet page log."""
    return split_page_log(spark.read.parquet(path))


def split_page_log(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    return log.drop("status"), log.select("page", "status")


def last_page(pages: DataFrame, answers: DataFrame, collection: str, limit: int = PAGE_LIMIT, whole: bool = True) -> DataFrame:
    """One row, one column: the last page to keep, NULL when nothing bounds it.

    Reading it raises if a page up to there is broken or, unless ``whole`` is false, missing. Pages are put together by
    blocks of their numbers, so what is looked at in one place is a row per 1,024 pages.
    """
    if "records" in pages.columns:
        size = F.col("records")
    else:
        # Only the array length matters here, so the records are parsed for one field.
        size = F.array_size(F.from_json("body", f"{collection} array<struct<id: string>>")[collection])
    sizes = pages.select("page", size.cast("bigint").alias("size"), size.isNull().alias("broken"), F.lit(False).alias("failed"))
    failures = answers.where("status is null or status <> 200").select(
        "page", F.lit(0).cast("bigint").alias("size"), F.col("status").isNull().alias("broken"), F.col("status").isNotNull().alias("failed")
    )
    by_page = sizes.unionByName(failures).groupBy("page").agg(
        F.sum("size").alias("size"), F.max("failed").alias("failed"), F.max("broken").alias("broken")
    )
    page, failed, broken = F.col("page"), F.col("failed"), F.col("broken")
    blocks = by_page.groupBy(F.floor(page / PAGES_IN_BLOCK).alias("block")).agg(
        F.min(F.when(~failed & ~broken & (F.col("size") < limit), page)).alias("short"),
        F.min(F.when(failed, page)).alias("bad"),
        F.min(F.when(broken & ~failed, page)).alias("broken"),
        F.collect_list(F.when(~failed, page)).alias("there"),
    )
    every = Window.partitionBy()
    bound = F.least(F.min("short").over(every), F.min("bad").over(every) - 1)
    reached = blocks.select("broken", "there", bound.alias("bound"))
    accepted = F.size(F.filter("there", lambda p: F.col("bound").isNull() | (p <= F.col("bound"))))
    return (
        reached.groupBy()
        .agg(
            F.max(F.array_contains("there", F.lit(1))).alias("begun"),
            F.max("bound").alias("end"),
            F.min("broken").alias("first_broken"),
            F.sum(accepted).alias("accepted"),
            F.max(F.array_max("there")).alias("top"),
        )
        .select(
            F.when(F.lit(whole) & ~F.coalesce("begun", F.lit(False)), _stop(F.lit(f"{collection}: {NO_FIRST_PAGE}")))
            .when(
                F.col("first_broken") <= F.coalesce("end", "first_broken"),
                _stop(F.concat(F.lit(f"{collection}: no records, envelope or status on page "), F.col("first_broken").cast("string"))),
            )
            .when(
                F.lit(whole) & (F.col("accepted") < F.coalesce("end", "top")),
                _stop(F.concat(F.lit(f"{collection}: pages are missing before page "), F.coalesce("end", "top").cast("string"))),
            )
            .otherwise(F.col("end"))
            .alias("last_page")
        )
    )


def _stop(message: Column) -> Column:
    return F.raise_error(message).cast("int")


def accept_pages(pages: DataFrame, answers: DataFrame, collection: str, limit: int = PAGE_LIMIT, whole: bool = True) -> DataFrame:
    bound = last_page(pages, answers, collection, limit, whole).scalar()
    return pages.where(F.coalesce(F.col("page") <= bound, F.lit(True)))


def paged_records(
    pages: DataFrame, answers: DataFrame, collection: str, record: str, limit: int = PAGE_LIMIT, whole: bool = True
) -> DataFrame:
    """All records of the accepted pages, with their page number in front."""
    bound = last_page(pages, answers, collection, limit, whole).scalar()
    accepted = _checked(accept_pages(pages, answers, collection, limit, whole), bound)
    return _records(accepted, f"{collection} array<struct<{record}>>", collection)


def single_page_records(pages: DataFrame, collection: str, record: str) -> DataFrame:
    """Records of page 1 of an enveloped collection; its status is not looked at, but it must be there."""
    first = pages.where("page = 1")
    checked = _checked(first, _first_page(first, F.lit(False), collection))
    return _records(checked, f"{collection} array<struct<{record}>>", collection).drop("page")


def single_page_array(pages: DataFrame, answers: DataFrame, record: str, collection: str = "export") -> DataFrame:
    """Elements of the top-level array on page 1, which must be there and have answered 200."""
    first = pages.where("page = 1")
    failed = answers.where("page = 1 AND (status IS NULL OR status <> 200)").exists()
    checked = _checked(first, _first_page(first, failed, collection))
    return _records(checked, f"array<struct<{record}>>", None).drop("page")


def _first_page(first: DataFrame, failed: Column, collection: str) -> Column:
    there = first.select(F.lit(1)).exists()
    return F.when(there & ~failed, F.lit(1)).otherwise(_stop(F.lit(f"{collection}: {NO_FIRST_PAGE}")))


def _checked(pages: DataFrame, check: Column) -> DataFrame:
    """``page, body`` and a branch of no rows that works out ``check``, so that it raises even where no page is read.

    The branch makes its columns from the check, so that no filter behind it can be seen to leave nothing of it.
    """
    guard = pages.sparkSession.range(1).withColumn("checked", check).where("checked < 0")
    return pages.select("page", "body").unionAll(guard.selectExpr("checked page", "cast(checked as string) body"))


def _records(pages: DataFrame, schema: str, collection: str | None) -> DataFrame:
    body = F.from_json("body", schema, _STRICT_JSON)
    records = body[collection] if collection else body
    missing = F.raise_error(F.concat(F.lit("no records on page "), F.col("page").cast("string")))
    return pages.select("page", F.inline(F.coalesce(records, missing)))
