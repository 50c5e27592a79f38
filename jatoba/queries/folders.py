"""The scratch folder of queries that run where nothing is configured: local masters only."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession


def ensure_work_folder(spark: SparkSession) -> None:
    """See that the context has a checkpoint folder.

    ``spark.checkpoint.dir`` is used if it is set. A local master without it gets a temporary
    folder that goes when the process ends; a cluster has to name a shared one.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="jatoba-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
