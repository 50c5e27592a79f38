"""Sinks: replaced tables, truncate-and-insert tables, CSV for checking.

A load writes a fresh folder and the table then moves over. A load that fails, on a bad
number or in the catalog, leaves the table as it was; readers of earlier loads are not cut
off while their folders are kept; no row is written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from jatoba.sources.tables import Lake


def replace_table(df: DataFrame, lake: Lake, layer: str, name: str) -> str:
    """The table with the frame's own schema and rows in place of the one there was; the folder it now has.

    With another schema the new table is made under a second name; the names are swapped as
    the last step, and the old table stays until that is done.
    """
    table, folder = lake.table(layer, name), lake.fresh_folder(layer, name)
    df.write.parquet(folder)
    catalog = lake.spark.catalog
    if not catalog.tableExists(table):
        catalog.createTable(table, path=folder, source="parquet", schema=df.schema)
    elif _same(lake.spark.table(table).schema, df.schema):
        _move(lake, table, folder)
    else:
        made, old = f"{table}_made", f"{table}_old"
        for left_over in (made, old):
            lake.spark.sql(f"DROP TABLE IF EXISTS {left_over}")
        catalog.createTable(made, path=folder, source="parquet", schema=df.schema)
        lake.spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
        try:
            lake.spark.sql(f"ALTER TABLE {made} RENAME TO {table}")
        except Exception:
            lake.spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
            raise
        lake.spark.sql(f"DROP TABLE {old}")
        catalog.refreshTable(table)
    lake.drop_old_loads(layer, name)
    return folder


def _same(one: StructType, other: StructType) -> bool:
    return [(f.name, f.dataType) for f in one] == [(f.name, f.dataType) for f in other]


def _move(lake: Lake, table: str, folder: str) -> None:
    lake.spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    lake.spark.catalog.refreshTable(table)


def truncate_insert(df: DataFrame, lake: Lake, layer: str, name: str, schema: str) -> str:
    """Replace all rows and keep the declared schema. Columns go in by position. The folder the table now has."""
    table, folder = lake.table(layer, name), lake.fresh_folder(layer, name)
    insert_into_folder(df, lake, f"{table}_next", schema, folder)
    if lake.spark.catalog.tableExists(table):
        _move(lake, table, folder)
    else:
        lake.spark.sql(f"CREATE TABLE {table} ({schema}) USING parquet LOCATION '{folder}'")
    lake.drop_old_loads(layer, name)
    return folder


def insert_into_folder(df: DataFrame, lake: Lake, passing: str, schema: str, folder: str) -> None:
    """Write rows by position into the declared columns, by way of a table that is there for that long."""
    lake.spark.sql(f"DROP TABLE IF EXISTS {passing}")
    lake.spark.sql(f"CREATE TABLE {passing} ({schema}) USING parquet LOCATION '{folder}'")
    df.write.insertInto(passing, overwrite=True)
    lake.spark.sql(f"DROP TABLE {passing}")


_CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, one file per task. Quotes are doubled, blanks kept; NULL is empty and '' is quoted."""
    df.write.mode("overwrite").options(**_CSV, nullValue="").csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read an export back; values may hold line breaks."""
    # The reader puts nullValue where nothing stands; a text no value has keeps '' apart from NULL.
    options = {**_CSV, "nullValue": "\0NULL", "multiLine": True, "lineSep": "\n"}
    return spark.read.schema(schema).options(**options).csv(path)
