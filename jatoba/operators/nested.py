"""Nested records to flat rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def quoted(name: str) -> str:
    """A column name that holds dots, ready for ``F.col``."""
    return f"`{name}`"


def flatten_structs(df: DataFrame) -> DataFrame:
    """Nested objects to dotted columns; arrays stay as they are.

    A missing parent gives NULL leaves.
    """
    return df.select([F.col(".".join(map(quoted, path))).alias(".".join(path)) for path in _leaves(df.schema)])


def _leaves(schema: StructType, parents: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    for field in schema.fields:
        path = (*parents, field.name)
        if isinstance(field.dataType, StructType):
            yield from _leaves(field.dataType, path)
        else:
            yield path


def explode_array(df: DataFrame, array: str | Column, keep: Sequence[Column], item: str, *, outer: bool) -> DataFrame:
    """One row per array element next to the kept parent columns.

    ``outer`` keeps a parent without elements as one row with a NULL element.
    """
    explode = F.explode_outer if outer else F.explode
    return df.select(*keep, explode(array).alias(item))


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Ordered column list, dotted names included."""
    return df.select([F.col(quoted(c)) for c in columns])


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Bag union by column name; a column a frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
