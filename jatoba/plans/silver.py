"""Silver: typed organizations and deals."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jatoba.functions.convert import parse_timestamp
from jatoba.operators.joins import lookup_left_join
from jatoba.operators.nested import quoted
from jatoba.operators.pivot import eav_pivot
from jatoba.schemas import (
    BRONZE_DEALS,
    CUSTOM_FIELD_COLUMNS,
    DEAL_TIMES,
    SILVER_DEAL_RENAMES,
    SILVER_DEALS,
    SILVER_ORGANIZATIONS,
    names,
)


def silver_organizations(bronze: DataFrame, as_of: datetime | None = None, strict: bool = True) -> DataFrame:
    """One row per organization with its custom fields as columns."""
    keys = [
        F.col("id").alias("company_id"),
        F.col("name"),
        parse_timestamp(F.col("created_at_x"), strict).alias("created_at"),
        parse_timestamp(F.col("updated_at_x"), strict).alias("updated_at"),
    ]
    wide = eav_pivot(bronze, keys, F.col("`custom_field.label`"), F.col("value"), CUSTOM_FIELD_COLUMNS)
    loaded = F.current_timestamp() if as_of is None else F.lit(as_of.isoformat())
    return wide.withColumn("dt_log", loaded.cast("timestamp_ntz")).select(names(SILVER_ORGANIZATIONS))


def silver_deals(bronze: DataFrame, funnels: DataFrame, strict: bool = True, **join_options) -> DataFrame:
    """Deals with the funnel of their stage.

    The funnels are made distinct first; a stage in two funnels still doubles its deals.
    ``bronze`` should be a table scan. ``join_options`` go to :func:`lookup_left_join`.
    """
    lookup = funnels.select(F.col("Name").alias("funnel_name"), F.col("DealStage_ID").alias("funnel_stage")).distinct()

    def typed(source: str) -> Column:
        c = F.col(quoted(source))
        return (parse_timestamp(c, strict) if source in DEAL_TIMES else c).alias(SILVER_DEAL_RENAMES.get(source, source))

    deals = bronze.select([typed(c) for c in BRONZE_DEALS])
    joined = lookup_left_join(deals, lookup, "stage_id", "funnel_stage", lookup_scan=False, **join_options)
    return joined.select(names(SILVER_DEALS))
