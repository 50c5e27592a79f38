"""Layer tables in the session catalog, kept as Parquet under one root."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from jatoba.session import file_system


@dataclass(frozen=True)
class Lake:
    """Names and places of the layer tables: ``<database>.<layer>_<name>``.

    Every load writes a fresh folder; ``kept_loads`` of them stay, the current one included,
    for readers that opened the table earlier.
    """

    spark: SparkSession
    root: str
    database: str = "crm"
    kept_loads: int = 3

    def create(self) -> Lake:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.root}'")
        return self

    def table(self, layer: str, name: str) -> str:
        return f"{self.database}.{layer}_{name}"

    def fresh_folder(self, layer: str, name: str) -> str:
        """A folder that no load has used; later ones sort after earlier ones."""
        return f"{self.root.rstrip('/')}/{layer}/{name}/load-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"

    def location(self, table: str) -> str:
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
        return described.first()["data_type"]

    def drop_old_loads(self, layer: str, name: str) -> None:
        """Remove the folders of all but the last ``kept_loads`` loads; the current one always stays."""
        files, folder = file_system(self.spark, f"{self.root.rstrip('/')}/{layer}/{name}")
        loads = sorted((s.getPath() for s in files.listStatus(folder) if s.getPath().getName().startswith("load-")), key=lambda p: p.getName())
        current = self.location(self.table(layer, name)).rstrip("/")
        for path in loads[: -max(1, self.kept_loads)]:
            if not current.endswith(path.getName()):
                files.delete(path, True)

    def is_at(self, layer: str, name: str, folder: str) -> bool:
        """Whether the table is there and holds the load in ``folder``."""
        table = self.table(layer, name)
        return self.spark.catalog.tableExists(table) and self.location(table).rstrip("/").endswith(folder.rstrip("/").rsplit("/", 1)[-1])

    def place(self, layer: str, name: str) -> str:
        """Where the current load of a table lies."""
        return self.location(self.table(layer, name))

    def read(self, layer: str, name: str) -> DataFrame:
        return self.spark.table(self.table(layer, name))
