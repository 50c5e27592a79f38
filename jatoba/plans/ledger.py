"""What a run has finished, so that it can go on where it stopped.

Each finished step leaves one row: what it read, as a digest, and the folder that it wrote. A step whose row has
the digest of what it would read now is not run again. What lies behind the steps of a later layer is the folder of an
earlier one, so a step that is done anew has all that follow from it done anew. Rows of one step lie in a folder of
their own, since steps finish at the same time.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jatoba.session import exists
from jatoba.sources.tables import Lake

ROW = "digest string, output string, at timestamp_ntz"


class Ledger:
    """The steps of the run ``run_id``."""

    def __init__(self, lake: Lake, run_id: str) -> None:
        if not run_id or set(run_id) & set("/=%"):
            raise ValueError("a run id is the name of a folder")
        self.lake, self.run_id = lake, run_id
        self.folder = f"{lake.root.rstrip('/')}/ledger/run={run_id}"

    def rows(self) -> DataFrame:
        """``digest, output, at, step`` of the run."""
        if not exists(self.lake.spark, self.folder):
            return self.lake.spark.createDataFrame([], f"{ROW}, step string")
        return self.lake.spark.read.schema(f"{ROW}, step string").option("basePath", self.folder).parquet(self.folder)

    def finished(self, step: str, digest: str) -> str | None:
        """The folder that the step wrote when it read what ``digest`` stands for."""
        if not exists(self.lake.spark, self._place(step)):
            return None
        last = self.rows().where(F.col("step") == step.replace(" ", "_")).orderBy(F.desc("at")).first()
        return last["output"] if last and last["digest"] == digest else None

    def finish(self, step: str, digest: str, output: str) -> None:
        row = self.lake.spark.createDataFrame([(digest, output, datetime.now())], ROW)
        row.coalesce(1).write.mode("append").parquet(self._place(step))

    def step(
        self, step: str, inputs: list, load: Callable[[], str], still_there: Callable[[str], bool] = lambda output: True
    ) -> str:
        """Run ``load`` unless the step is finished for these inputs and its output is still there; the folder either way."""
        digest = digest_of(inputs)
        output = self.finished(step, digest)
        if output is not None and still_there(output):
            return output
        context, tag = self.lake.spark.sparkContext, self.tag(step)
        context.addJobTag(tag)
        try:
            output = load()
        finally:
            context.removeJobTag(tag)
        self.finish(step, digest, output)
        return output

    def tag(self, step: str) -> str:
        """What the jobs of a step are marked with."""
        return f"{self.run_id} {step}".replace(" ", "-").replace(",", "-")

    def as_of(self, wanted: datetime | None) -> datetime:
        """The load time of the run: the one of its last attempt, unless another one is wanted."""
        noted = self.finished("begin", "")
        loaded = wanted.isoformat() if wanted else noted or datetime.now().isoformat()
        if loaded != noted:
            self.finish("begin", "", loaded)
        return datetime.fromisoformat(loaded)

    def _place(self, step: str) -> str:
        return f"{self.folder}/step={step.replace(' ', '_')}"


class NoLedger(Ledger):
    """Every step is run, none is noted."""

    def __init__(self, lake: Lake) -> None:
        super().__init__(lake, "none")

    def finished(self, step: str, digest: str) -> str | None:
        return None

    def finish(self, step: str, digest: str, output: str) -> None:
        pass


def digest_of(inputs: list) -> str:
    return sha256(json.dumps(inputs, default=str).encode()).hexdigest()


def files_digest(spark: SparkSession, *paths: str) -> list:
    """What stands for landed files: number, names, lengths and times, put together where they are listed. No file is read."""
    found = []
    for path in paths:
        if not exists(spark, path):
            found.append([path, None])
            continue
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        marks = F.xxhash64("path", "length", "modificationTime")
        found.append([path, *files.agg(F.count("*"), F.bit_xor(marks), F.sum("length")).first()])
    return found


def rows_digest(df: DataFrame) -> list:
    """What stands for the rows of a small table, in whatever order."""
    marks = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return list(df.agg(F.count("*"), F.bit_xor(marks), F.sum(marks.cast("decimal(38,0)"))).first())
