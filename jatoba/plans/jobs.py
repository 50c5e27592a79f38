"""The three loads, from landed pages to the two gold tables, and a run of all three that can be resumed."""

from __future__ import annotations

from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from jatoba import schemas
from jatoba.operators.publish import RUN, publish, write_member
from jatoba.operators.sinks import replace_table, truncate_insert
from jatoba.plans import bronze, gold, silver
from jatoba.plans.ledger import Ledger, NoLedger, files_digest, rows_digest
from jatoba.session import delete_folder, exists, shared_dir, together
from jatoba.sources import pages as source
from jatoba.sources.tables import Lake

GOLD_TABLES = {"negotiations": schemas.NEGOTIATION_FUNNEL, "captures": schemas.CAPTURE_FUNNEL}


def run_all(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    forest_map: DataFrame,
    run_id: str,
    *,
    as_of: datetime | None = None,
    layout: str = "files",
    limit: int = schemas.PAGE_LIMIT,
    strict: bool = True,
) -> Ledger:
    """All nine jobs as the run ``run_id``. Called again with the id, it does what is not finished or whose input has changed."""
    lake.create()
    ledger = Ledger(lake, run_id)
    loaded = ledger.as_of(as_of)
    run_bronze(spark, landing, lake, layout=layout, limit=limit, ledger=ledger)
    run_silver(lake, loaded, strict, ledger)
    run_gold(lake, forest_map, strict, ledger)
    return ledger


def run_bronze(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    *,
    layout: str = "files",
    limit: int = schemas.PAGE_LIMIT,
    ledger: Ledger | None = None,
) -> None:
    """Landed pages to the five bronze tables. ``layout`` is ``files`` or ``log``."""
    noted = ledger or NoLedger(lake)

    def landed(collection: str) -> tuple[DataFrame, DataFrame]:
        if layout == "log":
            return source.read_page_log(spark, f"{landing}/{collection}")
        return source.read_page_files(spark, landing, collection)

    def paged(collection: str, record: str) -> DataFrame:
        return source.paged_records(*landed(collection), collection, record, limit).drop("page")

    def organizations() -> DataFrame:
        return bronze.bronze_organizations(paged("organizations", schemas.ORGANIZATION_RECORD))

    def funnels() -> DataFrame:
        return bronze.bronze_funnels(
            source.single_page_array(*landed("deal_pipelines"), schemas.FUNNEL_RECORD, "deal_pipelines")
        )

    def stages() -> DataFrame:
        pages, _ = landed("deal_stages")
        return bronze.bronze_stages(source.single_page_records(pages, "deal_stages", schemas.STAGE_RECORD))

    def deals() -> DataFrame:
        return bronze.bronze_deals(paged("deals", schemas.DEAL_RECORD))

    def tasks() -> DataFrame:
        return bronze.bronze_tasks(paged("tasks", schemas.TASK_RECORD))

    def job(name: str, collection: str, rows) -> None:
        inputs = []
        if ledger:
            place = f"{landing}/{collection}"
            inputs = [layout, limit, files_digest(spark, place, f"{place}_status.csv")]
        noted.step(
            f"bronze {name}", inputs, lambda: replace_table(rows(), lake, "bronze", name), partial(lake.is_at, "bronze", name)
        )

    lake.create()
    together(
        partial(job, "organizations", "organizations", organizations),
        partial(job, "funnels", "deal_pipelines", funnels),
        partial(job, "stages", "deal_stages", stages),
        partial(job, "deals", "deals", deals),
        partial(job, "tasks", "tasks", tasks),
    )


def run_silver(lake: Lake, as_of: datetime | None = None, strict: bool = True, ledger: Ledger | None = None) -> None:
    """Bronze tables to the two silver tables."""
    noted = ledger or NoLedger(lake)

    def organizations() -> DataFrame:
        return silver.silver_organizations(lake.read("bronze", "organizations"), as_of, strict)

    def deals() -> DataFrame:
        return silver.silver_deals(lake.read("bronze", "deals"), lake.read("bronze", "funnels"), strict)

    def job(name: str, schema: str, sources: list[str], rows, *more) -> None:
        noted.step(
            f"silver {name}",
            [[lake.place("bronze", s) for s in sources], strict, *more],
            lambda: truncate_insert(rows(), lake, "silver", name, schema),
            partial(lake.is_at, "silver", name),
        )

    together(
        partial(job, "organizations", schemas.SILVER_ORGANIZATIONS, ["organizations"], organizations, as_of),
        partial(job, "deals", schemas.SILVER_DEALS, ["deals", "funnels"], deals),
    )


def run_gold(lake: Lake, forest_map: DataFrame, strict: bool = True, ledger: Ledger | None = None) -> None:
    """Silver tables, tasks and the map to the two gold tables, which change together.

    The base of both is computed once and staged, so that its joins run once; the copy goes
    when the tables are published, and also if this fails, unless a ledger keeps it for the next attempt.
    """
    noted = ledger or NoLedger(lake)
    spark = lake.spark
    loads = {"silver": ["organizations", "deals"], "bronze": ["tasks"]}
    inputs = [lake.place(layer, name) for layer, names in loads.items() for name in names]

    def base() -> str:
        folder = shared_dir(spark, "gold-base")
        rows = gold.gold_base(
            lake.read("silver", "organizations"),
            lake.read("silver", "deals"),
            lake.read("bronze", "tasks"),
            list(GOLD_TABLES.values()),
        )
        try:
            rows.write.parquet(folder)
        except Exception:
            delete_folder(spark, folder)
            raise
        return folder

    mapped = [*inputs, strict, rows_digest(forest_map) if ledger else None]

    def whole() -> str:
        staged = noted.step("gold base", inputs, base, partial(exists, spark))
        try:
            folder = noted.step("gold folder", mapped, lambda: lake.fresh_folder("gold", RUN))
            rows = spark.read.parquet(staged)

            def job(name: str, funnel: str) -> None:
                table = gold.gold_table(rows, forest_map, funnel, strict, rows_scan=True)
                noted.step(
                    f"gold {name}",
                    [folder, *mapped],
                    lambda: write_member(table, lake, "gold", name, schemas.GOLD, folder),
                    partial(exists, spark),
                )

            together(*[partial(job, name, funnel) for name, funnel in GOLD_TABLES.items()])
            publish(lake, "gold", list(GOLD_TABLES), schemas.GOLD, folder, {"run": noted.run_id, "inputs": inputs})
        except Exception:
            if not ledger:
                delete_folder(spark, staged)
            raise
        delete_folder(spark, staged)
        return folder

    noted.step("gold publication", mapped, whole, partial(lake.is_at, "gold", RUN))
