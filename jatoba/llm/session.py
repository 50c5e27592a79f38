"""What the queries and the pipeline ask of a session."""

from __future__ import annotations

from pyspark.sql import SparkSession

from jatoba.queries.folders import ensure_work_folder

ARROW_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
DEFAULT_BYTES = 64 << 20
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> None:
    """A checkpoint folder, and Arrow batches of 8 MB where the session has not chosen a size.

    Texts are long: at Spark's own 64 MB, a task holds several times that outside the heap.
    """
    ensure_work_folder(spark)
    if spark.conf.get(ARROW_BATCH, str(DEFAULT_BYTES)).rstrip("b") == str(DEFAULT_BYTES):
        spark.conf.set(ARROW_BATCH, str(BATCH_BYTES))
