"""Bronze: landed pages to flat tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jatoba import schemas
from jatoba.operators.nested import explode_array, flatten_structs, project


def bronze_organizations(records: DataFrame) -> DataFrame:
    """One row per organization and custom field; an organization without any keeps one row."""
    keep = [F.col("id"), F.col("name"), F.col("created_at"), F.col("updated_at")]
    fields = explode_array(records, "custom_fields", keep, "field", outer=True)
    return fields.select(
        "id",
        "name",
        F.col("field.custom_field.label").alias("custom_field.label"),
        F.col("field.value").alias("value"),
        F.col("created_at").alias("created_at_x"),
        F.col("updated_at").alias("updated_at_x"),
    )


def bronze_funnels(records: DataFrame) -> DataFrame:
    """One row per funnel and stage; a funnel without stages gives none."""
    stages = explode_array(records, "deal_stages", [F.col("name")], "stage", outer=False)
    return stages.select(
        F.col("name").alias("Name"),
        F.col("stage._id").alias("DealStage_ID"),
        F.col("stage.name").alias("DealStage_Name"),
    )


def bronze_stages(records: DataFrame) -> DataFrame:
    return project(flatten_structs(records), schemas.BRONZE_STAGES)


def bronze_deals(records: DataFrame) -> DataFrame:
    return project(flatten_structs(records), schemas.BRONZE_DEALS)


def bronze_tasks(records: DataFrame) -> DataFrame:
    return project(flatten_structs(records), schemas.BRONZE_TASKS)
