"""Views over the driver tables that stand in for trips, zones and a sparse zone graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowatlas.operators.cleaning import od_edges
from flowatlas.operators.graph import main_routes
from flowatlas.operators.ordering import following
from flowatlas.session import settle, store, widened

_C = F.col


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as trips from the supplier's nation to the customer's nation.

    Columns a query does not use are pruned down to the scans. Joins carry no hints: key tables small
    enough are broadcast, larger ones are shuffled with AQE splitting skewed keys.
    """
    line = table(spark, sf_dir, "lineitem")
    order = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    joined = (
        line.join(order, line["l_orderkey"] == order["o_orderkey"])
        .join(supplier, line["l_suppkey"] == supplier["s_suppkey"])
        .join(customer, order["o_custkey"] == customer["c_custkey"])
    )
    minutes = (_C("l_partkey") * 13 + _C("l_linenumber") * 7) % 320 - 9
    pickup = F.timestamp_add("HOUR", (_C("l_orderkey") % 24).cast("int"), _C("o_orderdate"))
    return joined.select(
        pickup.alias("pickup_datetime"),
        F.timestamp_add("MINUTE", minutes.cast("int"), pickup).alias("dropoff_datetime"),
        _C("s_nationkey").cast("int").alias("PULocationID"),
        _C("c_nationkey").cast("int").alias("DOLocationID"),
        (_C("l_quantity") * _C("l_discount")).alias("trip_distance"),
        minutes.cast("double").alias("trip_duration_minutes"),
        (_C("l_extendedprice") * _C("l_tax")).alias("fare_amount"),
        (_C("l_linenumber") - 1).cast("int").alias("passenger_count"),
    )


def raw_feed(spark: SparkSession, sf_dir: str, mapping: dict[str, str]) -> DataFrame:
    """``trips`` under the column names of a feed, without the duration."""
    return trips(spark, sf_dir).select(*[_C(target).alias(source) for target, source in mapping.items()])


def trip_edges(spark: SparkSession, sf_dir: str, profile: str = "base", min_trips: int = 50) -> DataFrame:
    """Aggregated once, then read by everything downstream."""
    return settle(od_edges(trips(spark, sf_dir), profile, min_trips))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as zones; some names and coordinates are missing on purpose."""
    nation = table(spark, sf_dir, "nation")
    key = _C("n_nationkey")
    placed = key % 12 != 0
    return nation.select(
        key.alias("zone_id"),
        F.when(key % 12 != 11, _C("n_name")).alias("zone_name"),
        F.when(placed, F.lit(30.0) + F.lit(0.5) * key).alias("latitude"),
        F.when(placed, F.lit(20.0) + F.lit(0.7) * key).alias("longitude"),
        (key % 5 == 0).alias("is_hotspot"),
        (key % 5 == 1).alias("is_secondary"),
        (key % 7 == 0).alias("is_hub"),
    )


def depot_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Goods moves between depots: from the supplier's depot to the depot the part is kept in.

    One narrow scan of the order lines and one combined aggregation; the number of depots is the
    number of suppliers, so the graph grows with the tables.
    """
    depots = table(spark, sf_dir, "supplier").agg(F.count("*")).scalar()
    moves = table(spark, sf_dir, "lineitem").select(
        _C("l_suppkey").alias("src"), (_C("l_partkey") % depots).alias("dst")
    )
    return moves.filter(_C("src") != _C("dst")).groupBy("src", "dst").agg(F.count("*").alias("weight"))


def depot_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All depot edges, aggregated once; a written table takes a quarter of a checkpoint's disk."""
    with widened(spark, table(spark, sf_dir, "lineitem").count()):
        return store(depot_edges(spark, sf_dir))


def busy_depots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minimum-trips rule: depot edges with at least twice the moves of the mean edge, whatever the size of the tables."""
    edges = depot_graph(spark, sf_dir)
    return settle(edges.filter(_C("weight") >= 2 * edges.agg(F.avg("weight")).scalar()))


def hops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the supplier of an order line to the supplier of the order's next line, counted.

    The next line is found without a window per order, so an order with a third of all lines is no hot key.
    """
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    with widened(spark, line.count()):
        moved = following(line, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], "l_suppkey", "dst")
    return moved.select(_C("l_suppkey").alias("src"), "dst").filter(_C("dst").isNotNull() & (_C("src") != _C("dst"))) \
        .groupBy("src", "dst").agg(F.count("*").alias("weight"))


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier's main route in ``hops``: sparse, with several components, at every size."""
    with widened(spark, table(spark, sf_dir, "lineitem").count()):
        return settle(main_routes(hops(spark, sf_dir)))


def outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six-sided outline per nation."""
    corner = F.explode(F.sequence(F.lit(0), F.lit(5))).alias("k")
    ring = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey", corner)
    angle = _C("k") * F.lit(3.141592653589793) / 3.0
    return ring.select(
        _C("n_nationkey").alias("zone_id"), "k",
        (_C("n_nationkey") + F.cos(angle)).alias("x"),
        (_C("n_regionkey") + 0.5 * F.sin(angle)).alias("y"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver embeddings as ``(id, vector)``."""
    return table(spark, sf_dir, "embeddings").select(
        _C("vec_id").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("vector")
    )
