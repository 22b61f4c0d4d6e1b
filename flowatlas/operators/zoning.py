"""Zone flags, weights, tiers and the configuration derived from flow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowatlas.operators.adjacency import vertex_ids
from flowatlas.operators.cleaning import zone_flow
from flowatlas.operators.graph import top_by, zone_label
from flowatlas.operators.ordering import global_rank
from flowatlas.session import settle
from flowatlas.sources.zones import CITY_DEFAULTS

# Traffic weight of each kind of zone.
HOTSPOT_WEIGHT, HUB_WEIGHT, SECONDARY_WEIGHT, DEFAULT_WEIGHT = 25.0, 15.0, 12.0, 1.0

# Last rank of each criticality tier.
CRITICAL_UPTO, HIGH_UPTO, MEDIUM_UPTO = 3, 7, 15


def zone_type(hotspot: Column, hub: Column) -> Column:
    return F.when(hotspot, "hotspot").when(hub, "hub").otherwise("normal")


def zone_types(zones: DataFrame) -> DataFrame:
    return zones.select("zone_id", zone_type(F.col("is_hotspot"), F.col("is_hub")).alias("zone_type"))


def zone_weights(zones: DataFrame) -> DataFrame:
    weight = (
        F.when(F.col("is_hotspot"), HOTSPOT_WEIGHT).when(F.col("is_hub"), HUB_WEIGHT)
        .when(F.col("is_secondary"), SECONDARY_WEIGHT).otherwise(DEFAULT_WEIGHT)
    )
    return zones.select("zone_id", weight.alias("zone_weight"))


def zone_summary(zones: DataFrame) -> DataFrame:
    return zones.agg(
        F.count("*").alias("zones"),
        F.count_if("is_hotspot").alias("hotspots"),
        F.count_if("is_secondary").alias("secondary"),
        F.count_if("is_hub").alias("hubs"),
    )


def criticality(rank: Column) -> Column:
    return (
        F.when(rank <= CRITICAL_UPTO, "critical").when(rank <= HIGH_UPTO, "high")
        .when(rank <= MEDIUM_UPTO, "medium").otherwise("normal")
    )


def critical_zones(scores: DataFrame, k: int = MEDIUM_UPTO) -> DataFrame:
    """The ``k`` highest-ranked zones with their tier."""
    return top_by(scores, "pagerank", k).withColumn("tier", criticality(F.col("rank")))


def auto_tiers(trips: DataFrame, meta: DataFrame | None = None, hotspot_pct: float = 0.10,
               secondary_pct: float = 0.15) -> DataFrame:
    """Zone table derived from raw trips: hotspot tier, then a share of the rest, by total flow."""
    flow = settle(zone_flow(trips))  # one row per zone: the trips are read once
    ranked = global_rank(flow, [F.desc("flow"), F.asc("id")])
    n = flow.agg(F.count("*")).scalar()
    hot = F.greatest(F.lit(1), F.floor(n * hotspot_pct)).cast("long")
    rest = n - hot
    second = F.when(rest > 0, F.greatest(F.lit(1), F.floor(rest * secondary_pct))).otherwise(0).cast("long")
    tiers = ranked.select(
        "id", "inbound", "outbound", "flow", "rank",
        F.when(F.col("rank") <= hot, "hotspot").when(F.col("rank") <= hot + second, "secondary")
        .otherwise("normal").alias("tier"),
    )
    if meta is None:
        columns = {"name": F.lit(None).cast("string"), "lat": F.lit(None).cast("double"),
                   "lon": F.lit(None).cast("double"), "hub": F.lit(None).cast("int")}
        tiers = tiers.withColumns(columns)
    else:
        tiers = tiers.join(meta.select("id", "name", "lat", "lon", "hub"), "id", "left")
    placed = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    return tiers.select(
        "id", zone_label(F.col("name"), F.col("id")).alias("name"), "inbound", "outbound", "flow", "rank", "tier",
        F.coalesce(F.col("hub") == 1, F.lit(False)).alias("is_hub"),
        F.when(placed, F.col("lat")).alias("latitude"), F.when(placed, F.col("lon")).alias("longitude"),
    )


def derived_config(trips: DataFrame, meta: DataFrame | None, name: str, country: str = "",
                   **settings) -> dict[str, DataFrame]:
    """Sections of a derived city config: one ``city`` row and one row per zone."""
    spark = trips.sparkSession
    values = {"name": name, "country": country, **CITY_DEFAULTS, **settings}
    city = spark.createDataFrame([values])
    return {"city": city, "zones": auto_tiers(trips, meta)}


def zone_ids(trips: DataFrame) -> DataFrame:
    """All zones seen as origin or destination."""
    return vertex_ids(trips.select(F.col("PULocationID").alias("src"), F.col("DOLocationID").alias("dst")))
