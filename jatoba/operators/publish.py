"""Tables that change together.

Tables of a layer that have one schema lie side by side in the folder of a run, and one catalog
table, ``<layer>_run``, holds the place of the run that readers see. Each table is a view over
it. A load writes all its tables first and a manifest next to them, and then moves
that one place: readers see the tables of one run, before it and after it, and a load that stops on the way
changes nothing for them.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jatoba.operators.sinks import insert_into_folder
from jatoba.session import delete_folder, exists, read_text, write_text
from jatoba.sources.tables import Lake

RUN = "run"
MEMBER = "_member"
MANIFEST = "_manifest.json"
# Each table of a run has a folder of its own below the run's.
_NESTED = "OPTIONS (recursiveFileLookup 'true')"


def write_member(df: DataFrame, lake: Lake, layer: str, name: str, schema: str, folder: str) -> str:
    """One table of a run, by position into the declared columns; what an earlier attempt left there goes."""
    place = f"{folder}/{name}"
    delete_folder(lake.spark, place)
    rows = df.select(F.lit(name).alias(MEMBER), *[F.col(f"`{c}`") for c in df.columns])
    insert_into_folder(rows, lake, f"{lake.table(layer, name)}_next", f"{MEMBER} string, {schema}", place)
    return place


def publish(lake: Lake, layer: str, names: Sequence[str], schema: str, folder: str, facts: dict | None = None) -> None:
    """Let readers see the run in ``folder``. All its tables must be there, whole.

    ``facts`` go into the manifest, which tells the tables of the run and the loads they come from.
    """
    for name in names:
        if not exists(lake.spark, f"{folder}/{name}/_SUCCESS"):
            raise RuntimeError(f"{layer}: {name} is not complete in {folder}")
    write_text(lake.spark, f"{folder}/{MANIFEST}", json.dumps({"tables": list(names), **(facts or {})}, sort_keys=True))
    _move_run(lake, layer, schema, folder)
    for name in names:
        _show(lake, layer, name)
    lake.drop_old_loads(layer, RUN)


def _move_run(lake: Lake, layer: str, schema: str, folder: str) -> None:
    run = lake.table(layer, RUN)
    if lake.spark.catalog.tableExists(run):
        lake.spark.sql(f"ALTER TABLE {run} SET LOCATION '{folder}'")
        lake.spark.catalog.refreshTable(run)
    else:
        lake.spark.sql(f"CREATE TABLE {run} ({MEMBER} string, {schema}) USING parquet {_NESTED} LOCATION '{folder}'")


def _show(lake: Lake, layer: str, name: str) -> None:
    """The view of one table, made at the first run; a table of the name, as loads used to write it, makes way."""
    view, run = lake.table(layer, name), lake.table(layer, RUN)
    if lake.spark.catalog.tableExists(view):
        if lake.spark.catalog.getTable(view).tableType == "VIEW":
            return
        lake.spark.sql(f"DROP TABLE {view}")
    columns = ", ".join(f"`{c}`" for c in lake.spark.table(run).columns if c != MEMBER)
    lake.spark.sql(f"CREATE VIEW {view} AS SELECT {columns} FROM {run} WHERE {MEMBER} = '{name}'")


def published(lake: Lake, layer: str) -> dict:
    """The manifest of the run that readers see."""
    return json.loads(read_text(lake.spark, f"{lake.location(lake.table(layer, RUN))}/{MANIFEST}"))
