"""Entity-attribute-value rows to one wide row per entity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def eav_pivot(
    df: DataFrame, keys: Sequence[Column], label: Column, value: Column, columns: Mapping[str, str]
) -> DataFrame:
    """``max(value)`` per label as a column, for the labels in ``columns`` (label -> name).

    One shuffle on the keys. Each task first folds its rows to one per key, so an
    entity with very many rows sends one row per task and not all of them.
    """
    picked = [F.max(F.when(label == F.lit(text), value)).alias(name) for text, name in columns.items()]
    return df.groupBy(*keys).agg(*picked)
