"""Area-weighted centroid of zone outlines given as vertex rows in planar coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def polygon_centroids(outline: DataFrame) -> DataFrame:
    """``(zone_id, area, x, y)`` from rows ``(zone_id, k, x, y)``, ``k`` numbering the vertices 0, 1, 2, ...

    Neighbouring vertices meet by an equi-join on (zone, k), not in a window, so an outline of any
    length spreads over all tasks. The closing side joins the first and last vertex of each zone.
    A zone whose area is 0 gets the mean of its vertices.
    """
    following = outline.select("zone_id", (F.col("k") - 1).alias("k"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    sides = outline.join(following, ["zone_id", "k"]).select("zone_id", "x", "y", "x2", "y2")
    closing = outline.groupBy("zone_id").agg(
        F.max_by("x", "k").alias("x"), F.max_by("y", "k").alias("y"),
        F.min_by("x", "k").alias("x2"), F.min_by("y", "k").alias("y2"),
    )
    cross = F.col("x") * F.col("y2") - F.col("x2") * F.col("y")
    sums = sides.unionByName(closing).groupBy("zone_id").agg(
        F.sum(cross).alias("twice"),
        F.sum((F.col("x") + F.col("x2")) * cross).alias("sx"),
        F.sum((F.col("y") + F.col("y2")) * cross).alias("sy"),
        F.avg("x").alias("mx"), F.avg("y").alias("my"),
    )
    flat = F.col("twice") == 0
    return sums.select(
        "zone_id", F.abs(F.col("twice") / 2.0).alias("area"),
        F.when(flat, F.col("mx")).otherwise(F.col("sx") / (3.0 * F.nullif("twice", F.lit(0.0)))).alias("x"),
        F.when(flat, F.col("my")).otherwise(F.col("sy") / (3.0 * F.nullif("twice", F.lit(0.0)))).alias("y"),
    )
