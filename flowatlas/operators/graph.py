"""The directed weighted zone graph as two relations, and its tables of one or two joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowatlas.functions.scalar import uniform
from flowatlas.operators.adjacency import vertex_ids
from flowatlas.operators.cleaning import density
from flowatlas.operators.ordering import exact_median, global_rank, top

MISSING_PREFIX = "Zone-"


def zone_label(name: Column, zone_id: Column) -> Column:
    return F.coalesce(name, F.concat(F.lit(MISSING_PREFIX), zone_id.cast("string")))


def named_vertices(ids: DataFrame, zones: DataFrame) -> DataFrame:
    """Ids with name and coordinates; unknown zones get ``Zone-<id>`` and (0, 0).

    No broadcast hint: Spark broadcasts the zone table when its size allows and shuffles it
    by the unique zone id otherwise.
    """
    return ids.join(zones, ids["id"] == zones["zone_id"], "left").select(
        ids["id"],
        zone_label(F.col("zone_name"), ids["id"]).alias("name"),
        F.coalesce("latitude", F.lit(0.0)).alias("latitude"),
        F.coalesce("longitude", F.lit(0.0)).alias("longitude"),
    )


def build_graph(edges: DataFrame, zones: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vertices, edges) of an origin-destination relation."""
    return named_vertices(vertex_ids(edges), zones), edges.withColumn("weight", F.col("weight").cast("long"))


def add_isolated(vertices: DataFrame, known: DataFrame) -> DataFrame:
    """Add ids of ``known`` that the graph does not contain."""
    extra = known.select("id").distinct().join(vertices, "id", "left_anti")
    return vertices.unionByName(extra, allowMissingColumns=True)


def named_edges(edges: DataFrame, zones: DataFrame) -> DataFrame:
    """Edges with names and coordinates of both ends."""
    def side(end: str) -> DataFrame:
        return zones.select(
            F.col("zone_id").alias(end), F.col("zone_name").alias(f"_{end}_name"),
            F.coalesce("latitude", F.lit(0.0)).alias(f"_{end}_lat"),
            F.coalesce("longitude", F.lit(0.0)).alias(f"_{end}_lon"),
        )

    joined = edges.join(side("src"), "src", "left").join(side("dst"), "dst", "left")
    extra = []
    for end in ("src", "dst"):
        extra += [
            zone_label(F.col(f"_{end}_name"), F.col(end)).alias(f"{end}_name"),
            F.coalesce(f"_{end}_lat", F.lit(0.0)).alias(f"{end}_lat"),
            F.coalesce(f"_{end}_lon", F.lit(0.0)).alias(f"{end}_lon"),
        ]
    return joined.select(*edges.columns, *extra)


def heaviest(edges: DataFrame, n: int) -> DataFrame:
    """The ``n`` busiest edges (a top-k sort, no full sort)."""
    return edges.orderBy(F.desc("weight"), "src", "dst").limit(n)


def located(edges: DataFrame) -> DataFrame:
    return edges.filter((F.col("src_lat") != 0) & (F.col("dst_lat") != 0))


def map_edges(edges: DataFrame, zones: DataFrame, n: int = 300) -> DataFrame:
    """Busiest ``n`` edges first, then those without coordinates are dropped."""
    return located(named_edges(heaviest(edges, n), zones))


def per_vertex(edges: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Degree and weighted flow of every vertex in both directions, one pass over the edges."""
    ends = edges.select(*keys, "weight", F.posexplode(F.array("src", "dst")).alias("side", "id"))
    leaving = F.col("side") == 0
    return ends.groupBy(*keys, "id").agg(
        F.count("*").alias("degree"),
        F.count_if(~leaving).alias("in_degree"),
        F.count_if(leaving).alias("out_degree"),
        F.sum(F.when(leaving, 0).otherwise(F.col("weight"))).cast("long").alias("in_flow"),
        F.sum(F.when(leaving, F.col("weight")).otherwise(0)).cast("long").alias("out_flow"),
    )


def degree_centrality(edges: DataFrame) -> DataFrame:
    """In- and out-degree as a share of the other vertices; 1 in a graph of one vertex."""
    counts = per_vertex(edges).select("id", "in_degree", "out_degree")
    others = (vertex_ids(edges).agg(F.count("*").alias("n")).scalar() - 1).cast("double")

    def share(column: str) -> Column:
        return F.when(others > 0, F.col(column) / others).otherwise(1.0)

    return counts.select(
        "id", share("in_degree").alias("in_centrality"), share("out_degree").alias("out_centrality")
    )


def graph_stats(edges: DataFrame) -> DataFrame:
    """One row: nodes, edges, flow, density, average degree."""
    totals = per_vertex(edges).agg(
        F.count("*").alias("nodes"),
        F.coalesce(F.sum("out_degree"), F.lit(0)).alias("edges"),
        F.coalesce(F.sum("out_flow"), F.lit(0)).cast("long").alias("flow"),
    )
    return totals.withColumn("density", density(F.col("nodes"), F.col("edges"))).withColumn(
        "avg_degree", 2.0 * F.col("edges") / F.nullif(F.col("nodes"), F.lit(0))
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Non-empty equal-width bins over [min, max]; the last bin includes the maximum.

    A constant column gets a range of width 1 around its value. ``log_count`` is the
    frequency on a log axis.
    """
    values = df.select(F.col(column).cast("double").alias("v"))
    bounds = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    low, high = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    flat = low == high
    start = F.when(flat, low - 0.5).otherwise(low)
    width = F.when(flat, F.lit(1.0)).otherwise(high - low)
    position = F.floor((F.col("v") - start) * bins / width).cast("int")
    binned = values.select(F.least(position, F.lit(bins - 1)).alias("bin"), start.alias("s"), width.alias("w"))
    counted = binned.groupBy("bin").agg(F.count("*").alias("n"), F.min("s").alias("s"), F.min("w").alias("w"))
    return counted.select(
        "bin",
        (F.col("s") + F.col("bin") * F.col("w") / bins).alias("lower"),
        (F.col("s") + (F.col("bin") + 1) * F.col("w") / bins).alias("upper"),
        "n",
        F.log10("n").alias("log_count"),
    )


def edge_weight_histogram(edges: DataFrame, bins: int = 50) -> DataFrame:
    return histogram(edges, "weight", bins)


def degree_histogram(edges: DataFrame, bins: int = 30) -> DataFrame:
    return histogram(per_vertex(edges), "degree", bins)


def distribution_summary(edges: DataFrame) -> DataFrame:
    """Median edge weight and mean degree, the marker lines of the two histograms."""
    median = exact_median(edges, "weight")
    return per_vertex(edges).agg(F.avg("degree").alias("mean_degree")).withColumn("median_weight", median.scalar())


def undirected(edges: DataFrame, keys: tuple[str, ...] = (), combine: str = "sum") -> DataFrame:
    """One row per unordered pair; weights of a reciprocal pair are added (or the larger kept)."""
    merge = {"sum": F.sum, "max": F.max}[combine]
    return (
        edges.groupBy(*keys, F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
        .agg(merge("weight").cast("long").alias("weight"))
    )


def isolated_ratio(vertices: DataFrame, edges: DataFrame, warn_above: float = 0.2) -> DataFrame:
    """How many vertices have no edge; embeddings of a fragmented graph mean little."""
    touched = vertex_ids(edges).withColumn("touched", F.lit(1))
    counts = vertices.select("id").join(touched, "id", "left").agg(
        F.count("*").alias("nodes"), F.count_if(F.col("touched").isNull()).alias("isolated")
    )
    ratio = F.coalesce(F.col("isolated") / F.nullif(F.col("nodes").cast("double"), F.lit(0.0)), F.lit(0.0))
    return counts.withColumn("ratio", ratio).withColumn("fragmented", F.col("ratio") > warn_above)


def induced_subgraph(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """Edges whose two ends are both in ``vertices``."""
    ids = vertices.select("id")
    return (
        edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi")
        .join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
    )


def remove_vertices(edges: DataFrame, gone: DataFrame) -> DataFrame:
    """Edges that touch no removed vertex."""
    ids = gone.select("id")
    return (
        edges.join(ids.withColumnRenamed("id", "src"), "src", "left_anti")
        .join(ids.withColumnRenamed("id", "dst"), "dst", "left_anti")
    )


def edge_sample(edges: DataFrame, target: int = 10_000, seed: int = 42) -> DataFrame:
    """Repeatable row sample of expected size ``target``; everything when there are fewer edges."""
    count = edges.agg(F.count("*")).scalar()
    draw = uniform(F.concat_ws("#", "src", "dst", F.lit(seed)))
    return edges.filter(draw < F.lit(float(target)) / F.greatest(count, F.lit(1)))


def by_score(column: str) -> list[Column]:
    """Descending score, ties by id. Scores equal in single precision are ties, so that the order
    does not hang on the order in which doubles were added."""
    return [F.col(column).cast("float").desc(), F.asc("id")]


def rank_by(scores: DataFrame, column: str, name: str = "rank") -> DataFrame:
    """Position of every vertex by descending score."""
    return global_rank(scores, by_score(column), name)


def top_by(scores: DataFrame, column: str, k: int, name: str = "rank") -> DataFrame:
    return top(scores, by_score(column), k, name)


def main_routes(edges: DataFrame) -> DataFrame:
    """``(src, dst, weight)``: the heaviest edge out of every vertex; among equal ones a hash of the edge decides.

    At most one edge per vertex at any size, so this graph stays sparse where the whole one links nearly every pair. One combined aggregation.
    """
    draw = F.md5(F.concat_ws("#", "src", "dst"))
    best = F.max(F.struct("weight", draw.alias("draw"), "dst")).alias("best")
    return edges.groupBy("src").agg(best).select("src", "best.dst", "best.weight")


def returning(edges: DataFrame) -> DataFrame:
    """Edges whose reverse is an edge too."""
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return edges.join(back, ["src", "dst"], "left_semi")
