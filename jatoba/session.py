"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "jatoba", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine is written for.

    ANSI mode makes bad casts raise (strict loads); AQE coalesces small shuffle
    partitions and splits the skewed ones that are below the salting threshold.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the folder named by ``spark.checkpoint.dir``, which every executor must see."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a reader of the copy.

    Used where one result feeds several outputs: the copy cuts the lineage, so a
    lost executor costs a re-read and not a re-run of the joins behind it.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """The same for as long as the block runs; the copy is removed at its end."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_folder(spark, path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the actions of frames made in the block go when the action ends, not when the driver collects its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """An eager checkpoint that leaves no shuffle files behind."""
    with shuffles_removed(df.sparkSession):
        return df.select("*").checkpoint()


def file_system(spark: SparkSession, path: str) -> tuple:
    """The file system that a path lies in, and the path as it takes it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = file_system(spark, path)
    return files.exists(place)


def delete_folder(spark: SparkSession, path: str) -> None:
    files, place = file_system(spark, path)
    files.delete(place, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, in place of the one there was."""
    files, place = file_system(spark, path)
    out = files.create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, also one whose name hides it from Spark's readers."""
    files, place = file_system(spark, path)
    stream = files.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def together(*loads: Callable[[], None]) -> None:
    """Run independent loads at the same time, so that a small one does not hold up the rest."""
    with ThreadPoolExecutor(len(loads)) as pool:
        for running in [pool.submit(load) for load in loads]:
            running.result()
