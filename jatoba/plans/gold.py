"""Gold: organizations with the deals of one funnel, as points joined to the forest map."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jatoba.functions import geo
from jatoba.operators.joins import (
    MAX_HOT_KEYS,
    MIN_HOT_ROWS,
    SPREAD,
    HotKeys,
    find_hot_keys,
    lookup_left_join,
    profile,
    semi_reduce,
    sliced_join,
    with_spread,
)
from jatoba.schemas import GOLD, GOLD_DEAL_COLUMNS, GOLD_ORGANIZATION_COLUMNS, names


def task_counts(tasks: DataFrame) -> DataFrame:
    """Tasks per deal. Tasks without a deal can match nothing and are left out early."""
    return (
        tasks.where(F.col("deal_id").isNotNull())
        .groupBy(F.col("deal_id").alias("task_deal_id"))
        .agg(F.count(F.lit(1)).alias("qtde_tarefas"))
    )


def gold_base(
    organizations: DataFrame,
    deals: DataFrame,
    tasks: DataFrame,
    funnels: Sequence[str],
    min_hot_rows: int = MIN_HOT_ROWS,
    **reduce_options,
) -> DataFrame:
    """Distinct organization x deal rows of the given funnels.

    Only rows with a funnel name survive, so an organization needs a deal and the join to
    the deals is an inner one; the funnel filter stands at the deal scan. ``organizations``
    and ``deals`` should be table scans.

    A digest stands for the output columns of an organization through the joins and the
    distinct, and equal rows have equal digests whichever organization they come from. The
    wide columns come in last, once per digest. Rows go to (digest, slice) before the
    distinct, the slice taken from their content: equal rows meet, the last join needs no
    further exchange, and a digest that very many rows share is split.

    Only tasks of wanted deals are counted: the rest is held back at the task scan, see
    :func:`semi_reduce`, which takes ``reduce_options``.
    """
    wanted = deals.where(F.col("funnel_name").isin(*funnels) & F.col("organization_id").isNotNull())
    wanted = wanted.select([F.col(c).alias(name) for c, name in GOLD_DEAL_COLUMNS.items()])
    places = organizations.select(
        *[F.col(c).alias(name) for c, name in GOLD_ORGANIZATION_COLUMNS.items()],
        geo.full_coordinate(F.col("registro_rural"), F.col("coordenada")).alias("coordenada_completa"),
    )
    shown = [c for c in places.columns if c != "company_id"]
    places = places.withColumn("digest", F.sha2(F.to_json(F.struct(*shown)), 256))
    # Read by the sketch and by the join: worked out once.
    keyed = places.select("company_id", "digest").checkpoint()

    deals_profile = profile(wanted, "deal", "organization_id", min_rows=min_hot_rows)
    hot = deals_profile.hot
    hot_places = find_hot_keys(keyed, "company_id", "digest", min_rows=min_hot_rows)
    if any(hot.values()):
        wanted = with_spread(wanted)
    counts = task_counts(semi_reduce(tasks, "deal_id", wanted, "deal", deals_profile.sizes["deal"], **reduce_options))
    counted = sliced_join(wanted, counts, "deal", "task_deal_id", left_hot=hot["deal"])
    named = sliced_join(
        counted.drop("deal", "task_deal_id"),
        with_spread(keyed) if hot_places["company_id"] else keyed,
        "organization_id",
        "company_id",
        "inner",
        left_hot=hot["organization_id"],
        right_hot=hot_places["company_id"],
    ).drop("organization_id", "company_id", SPREAD)

    slices = _hot_digests(keyed, hot["organization_id"], hot_places["digest"])
    wide = places.select("digest", *shown).withColumnRenamed("digest", "place").dropDuplicates(["place"])
    if slices:
        content = F.xxhash64(*named.columns)
        named = named.withColumn("_slice", F.pmod(content, slices.slice_count(F.col("digest"), with_null=False)).cast("int"))
        copies = F.sequence(F.lit(0), slices.slice_count(F.col("place"), with_null=False) - 1)
        wide = wide.withColumn("_slice_copy", F.explode(copies))
    parted = [c for c in ("digest", "_slice") if c in named.columns]
    rows = named.repartition(*parted).distinct()
    on = F.col("digest") == F.col("place")
    if slices:
        on = on & (F.col("_slice") == F.col("_slice_copy"))
    return rows.join(wide, on).drop("digest", "place", "_slice", "_slice_copy")


def _hot_digests(keyed: DataFrame, organizations: HotKeys, digests: HotKeys) -> HotKeys:
    """Digests that many organizations share, and those of the hot organizations, with their slices.

    Each digest of a hot organization meets all its deals, so beyond MAX_HOT_KEYS of them no
    single one has a share of the rows that is worth cutting.
    """
    counts = dict(digests.counts())
    if organizations:
        hot = keyed.where(F.col("company_id").isin([k for k in organizations.counts() if k is not None]))
        slices = organizations.slice_count(F.col("company_id"), with_null=False)
        found = hot.groupBy("digest").agg(F.max(slices).alias("n")).orderBy(F.desc("n"), "digest").limit(MAX_HOT_KEYS)
        for digest, n in found.collect():
            counts[digest] = max(counts.get(digest, 1), n)
    return HotKeys.of(counts)


def map_lookup(forest_map: DataFrame) -> DataFrame:
    """The map with its integer key as text: '07' and 7 do not match."""
    return forest_map.select(F.col("id_organizacao").cast("string").alias("map_id"), "geom")


def gold_table(
    base: DataFrame, forest_map: DataFrame, funnel: str, strict: bool = True, **join_options
) -> DataFrame:
    """The 24 columns of one gold table.

    The funnel filter comes before the casts: a bad coordinate fails only its own load.
    ``join_options`` go to :func:`lookup_left_join`; give ``rows_scan=True`` for a staged base.
    """
    located = base.where(F.col("funnel_name") == funnel).withColumns(
        {
            "latitude": geo.latitude(F.col("coordenada_completa"), strict),
            "longitude": geo.longitude(F.col("coordenada_completa"), strict),
        }
    )
    options = {"rows_scan": False, **join_options}
    mapped = lookup_left_join(located, map_lookup(forest_map), "id_organizacao", "map_id", **options)
    points = geo.point(F.col("longitude"), F.col("latitude"))
    return mapped.withColumns({"ponto": points, "nome_funil": F.col("funnel_name")}).select(names(GOLD))


def bad_coordinates(base: DataFrame, funnel: str) -> DataFrame:
    """The rows of a funnel whose coordinate a strict load would stop at, with the reason."""
    status = geo.coordinate_status(F.col("coordenada_completa"))
    rows = base.where(F.col("funnel_name") == funnel).withColumn("coord_status", status)
    return rows.where(F.col("coord_status").isin("bad_latitude", "bad_longitude"))
