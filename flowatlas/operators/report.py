"""The tables a user reads: features, feeds for maps and charts, the map document, the summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowatlas.functions.scalar import ratio_to_max
from flowatlas.operators.community import group_sizes_scalar
from flowatlas.operators.graph import (degree_centrality, graph_stats, heaviest, induced_subgraph, located,
                                       map_edges, named_edges, named_vertices, per_vertex, rank_by, top_by)
from flowatlas.operators.skew import join_unique
from flowatlas.operators.zoning import zone_type
from flowatlas.session import settle

# Map centre used when no zone has coordinates.
DEFAULT_CENTRE = (41.0, 29.0)
UNRANKED = 999


def node_features(edges: DataFrame, zones: DataFrame, scores: DataFrame, between: DataFrame,
                  communities: DataFrame) -> DataFrame:
    """One row per zone with every score, its share of the largest, community, kind and rank.

    ``communities`` is ``(id, community)``. All joins are on the unique zone id.
    """
    flags = zones.select(F.col("zone_id").alias("id"), "is_hotspot", "is_hub")
    ranked = rank_by(scores, "pagerank")
    flows = per_vertex(edges).select("id", "in_flow", "out_flow")
    table = (
        named_vertices(ranked, zones)
        .join(ranked, "id").join(between, "id", "left").join(flows, "id", "left")
        .join(communities.select("id", "community"), "id", "left").join(flags, "id", "left")
    )
    best_rank = scores.agg(F.max("pagerank")).scalar()
    best_between = between.agg(F.max("betweenness")).scalar()
    best_in = flows.agg(F.max("in_flow")).scalar()
    return table.select(
        "id", "name", "latitude", "longitude", "pagerank",
        ratio_to_max(F.col("pagerank"), best_rank).alias("pagerank_norm"),
        F.coalesce("betweenness", F.lit(0.0)).alias("betweenness"),
        ratio_to_max(F.coalesce("betweenness", F.lit(0.0)), best_between).alias("betweenness_norm"),
        "in_flow", "out_flow",
        ratio_to_max(F.col("in_flow"), best_in).alias("in_flow_norm"),
        F.coalesce("community", F.lit(0)).cast("int").alias("community"),
        zone_type(F.col("is_hotspot"), F.col("is_hub")).alias("zone_type"),
        F.col("rank"),
    )


def edge_features(edges: DataFrame, zones: DataFrame, n: int = 300) -> DataFrame:
    """Busiest edges with names, coordinates and weight as a share of the largest."""
    largest = edges.agg(F.max("weight")).scalar()
    shown = map_edges(edges.select("src", "dst", "weight", "avg_duration"), zones, n)
    return shown.withColumn("weight_norm", F.col("weight") / largest)


def centre(vertices: DataFrame, default: tuple[float, float] = DEFAULT_CENTRE) -> DataFrame:
    """Mean position of the located zones."""
    placed = (F.col("latitude") != 0) & (F.col("longitude") != 0)
    return vertices.agg(
        F.coalesce(F.avg(F.when(placed, F.col("latitude"))), F.lit(default[0])).alias("center_lat"),
        F.coalesce(F.avg(F.when(placed, F.col("longitude"))), F.lit(default[1])).alias("center_lon"),
    )


def top_bottlenecks(vertices: DataFrame, scores: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` best-ranked zones first, then those without coordinates are dropped."""
    best = top_by(scores, "pagerank", n).join(vertices, "id")
    return best.filter((F.col("latitude") != 0) & (F.col("longitude") != 0))


def centrality_heat(edges: DataFrame, scores: DataFrame, between: DataFrame, n: int = 20) -> DataFrame:
    """Four scores of the ``n`` best-ranked zones, each divided by its maximum over those zones."""
    best = top_by(scores, "pagerank", n)
    # n rows: written once, then their maxima are read from them.
    table = settle(best.join(between, "id", "left").join(degree_centrality(edges), "id", "left").fillna(0.0))
    columns = ["pagerank", "betweenness", "in_centrality", "out_centrality"]
    largest = table.agg(*[F.max(c).alias(c) for c in columns])
    return table.select(
        "rank", "id", *[ratio_to_max(F.col(c), largest.select(c).scalar()).alias(c) for c in columns]
    )


def degree_heat(edges: DataFrame, scores: DataFrame, n: int = 20) -> DataFrame:
    """PageRank and degree of the ``n`` best-ranked zones, each divided by its maximum."""
    degrees = per_vertex(edges).select("id", "degree")
    table = settle(top_by(scores, "pagerank", n).join(degrees, "id", "left").fillna(0))
    largest = table.agg(F.max("pagerank").alias("p"), F.max("degree").alias("d"))
    return table.select(
        "rank", "id",
        ratio_to_max(F.col("pagerank"), largest.select("p").scalar()).alias("pagerank"),
        ratio_to_max(F.col("degree"), largest.select("d").scalar()).alias("degree"),
    )


def rank_versus_betweenness(edges: DataFrame, scores: DataFrame, between: DataFrame) -> DataFrame:
    """Both scores of every zone, marker size by in-degree, the five best labelled."""
    labels = top_by(scores, "pagerank", 5).select("id", F.lit(True).alias("labelled"))
    size = F.greatest(F.coalesce("in_centrality", F.lit(0.0)) * 2000.0, F.lit(20.0))
    return (
        scores.join(between, "id").join(degree_centrality(edges), "id", "left").join(labels, "id", "left")
        .select("id", "pagerank", "betweenness", size.alias("size"),
                F.coalesce("labelled", F.lit(False)).alias("labelled"))
    )


def rank_disagreement(scores: DataFrame, between: DataFrame) -> DataFrame:
    """Betweenness rank next to PageRank rank."""
    by_between = rank_by(between, "betweenness", "betweenness_rank")
    by_score = rank_by(scores, "pagerank", "pagerank_rank")
    largest = between.agg(F.max("betweenness")).scalar()
    return by_between.join(by_score, "id").select(
        "id", "betweenness", ratio_to_max(F.col("betweenness"), largest).alias("betweenness_norm"),
        "betweenness_rank", "pagerank_rank",
        (F.col("pagerank_rank") - F.col("betweenness_rank")).alias("gap"),
    )


def geo_feed(edges: DataFrame, vertices: DataFrame, zones: DataFrame, scores: DataFrame,
             communities: DataFrame, n: int = 200) -> dict[str, DataFrame]:
    """Located zones with size, colour and label flag; busiest located edges with line width."""
    count = F.greatest(communities.agg(F.max("community") + 1).scalar(), F.lit(1))
    labels = top_by(scores, "pagerank", 10).select("id", F.lit(True).alias("labelled"))
    nodes = (
        vertices.filter((F.col("latitude") != 0) & (F.col("longitude") != 0))
        .join(scores, "id").join(communities.select("id", "community"), "id", "left").join(labels, "id", "left")
        .select(
            "id", "latitude", "longitude",
            F.greatest(F.col("pagerank") * 50000.0, F.lit(30.0)).alias("size"),
            (F.coalesce("community", F.lit(0)) / count).alias("colour"),
            F.coalesce("labelled", F.lit(False)).alias("labelled"),
        )
    )
    # Located first, then the limit (the map document does it the other way round).
    shown = settle(heaviest(located(named_edges(edges.select("src", "dst", "weight"), zones)), n))
    largest = shown.agg(F.max("weight")).scalar()
    share = F.col("weight") / largest
    lines = shown.select("src", "dst", "weight", (0.3 + share * 2.0).alias("width"), (0.05 + share * 0.3).alias("opacity"))
    return {"nodes": nodes, "edges": lines}


def topology_feed(edges: DataFrame, scores: DataFrame, communities: DataFrame, n: int = 40) -> dict[str, DataFrame]:
    """Subgraph of the ``n`` best-ranked zones with sizes, colours, labels and line widths."""
    best = top_by(scores, "pagerank", n)
    nodes = best.join(communities.select("id", "community"), "id", "left").select(
        "id", (F.col("pagerank") * 30000.0).alias("size"), F.coalesce("community", F.lit(0)).cast("int").alias("community"),
        (F.col("rank") <= 15).alias("labelled"),
    )
    inner = settle(induced_subgraph(edges.select("src", "dst", "weight"), best))
    share = F.col("weight") / inner.agg(F.max("weight")).scalar()
    lines = inner.select("src", "dst", "weight", (0.5 + share * 3.0).alias("width"), (0.1 + share * 0.4).alias("opacity"))
    return {"nodes": nodes, "edges": lines}


def visible_map(features: DataFrame, shown_edges: DataFrame, removed: DataFrame, max_rank: int,
                n_edges: int) -> dict[str, DataFrame]:
    """What the map draws after some zones were removed: the first ``n_edges`` edges touching none of
    them, and located zones that rank high enough or were removed."""
    flags = settle(removed.select("id").distinct().withColumn("gone", F.lit(True)))
    rows = flags.count()  # a table of the caller: sent to all tasks only below the bound
    untouched = shown_edges
    for end in ("src", "dst"):
        untouched = join_unique(untouched, flags.withColumnRenamed("id", end), [end], rows, "left").filter(F.col("gone").isNull()).drop("gone")
    located_ = features.filter((F.col("latitude") != 0) & (F.col("longitude") != 0))
    nodes = (
        join_unique(located_, flags, ["id"], rows, "left").withColumn("gone", F.coalesce("gone", F.lit(False)))
        .filter((F.col("rank") <= max_rank) | F.col("gone"))
    )
    return {"nodes": nodes, "edges": heaviest(untouched, n_edges)}


def full_stats(edges: DataFrame, components: DataFrame, communities: DataFrame) -> DataFrame:
    """Graph statistics with the number of weak components and communities."""
    return graph_stats(edges).withColumn(
        "components", group_sizes_scalar(components, "component")
    ).withColumn("communities", group_sizes_scalar(communities, "community"))


def map_document(city: dict[str, str], vertices: DataFrame, features: DataFrame, shown_edges: DataFrame,
                 timeline: DataFrame, summaries: DataFrame, stats: DataFrame) -> dict[str, DataFrame]:
    """Sections of the map document; city and stats are single rows, the others record lists."""
    spark: SparkSession = vertices.sparkSession
    header = spark.createDataFrame([city], ", ".join(f"{k} string" for k in city))
    middle = centre(vertices)
    header = header.withColumns({
        "center_lat": F.round(middle.select("center_lat").scalar(), 4),
        "center_lon": F.round(middle.select("center_lon").scalar(), 4),
        "zoom": F.lit(11),
    })
    nodes = features.withColumns({
        c: F.round(c, d) for c, d in
        {"pagerank": 6, "pagerank_norm": 4, "betweenness": 6, "betweenness_norm": 4, "in_flow_norm": 4}.items()
    }).withColumnsRenamed({"latitude": "lat", "longitude": "lon"})
    edges = shown_edges.withColumn("weight_norm", F.round("weight_norm", 4)).withColumn(
        "avg_duration", F.round("avg_duration", 1))
    simulation = timeline.filter(F.col("step") > 0).withColumns({
        c: F.round(c, 2) for c in ("remaining_flow_pct", "remaining_edge_pct")
    })
    communities = summaries.withColumn("avg_pagerank", F.round("avg_pagerank", 6))
    return {"city": header, "nodes": nodes, "edges": edges, "simulation": simulation,
            "communities": communities, "stats": stats}


def read_map_document(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of a map document: one nested JSON file, or a folder of sections.

    Fields a record lacks get the defaults of the format; edges without both ends are dropped.
    """
    node_schema = "id long, name string, lat double, lon double, pagerank double, community long, rank long, zone_type string"
    edge_schema = "src long, dst long, weight long"
    if path.rstrip("/").endswith(".json"):
        schema = f"nodes array<struct<{node_schema.replace(' ', ':').replace(',:', ',')}>>, " \
                 f"edges array<struct<{edge_schema.replace(' ', ':').replace(',:', ',')}>>"
        document = spark.read.schema(schema).option("multiLine", True).json(path)
        nodes = document.select(F.explode("nodes").alias("n")).select("n.*")
        edges = document.select(F.explode("edges").alias("e")).select("e.*")
    else:
        nodes = spark.read.schema(node_schema).json(f"{path}/nodes")
        edges = spark.read.schema(edge_schema).json(f"{path}/edges")
    defaults = {"lat": 0.0, "lon": 0.0, "pagerank": 0.0, "community": 0, "rank": UNRANKED, "zone_type": "normal"}
    return nodes.fillna(defaults), edges.dropna(subset=["src", "dst"]).fillna({"weight": 1})


def summary_report(stats: DataFrame, scores: DataFrame, names: DataFrame, timeline: DataFrame) -> DataFrame:
    """Rows ``(metric, label, value)``: sizes, the five best zones, losses, components before and after."""
    def single(metric: str, value) -> DataFrame:
        return stats.select(F.lit(metric).alias("metric"), F.lit("").alias("label"), value.cast("double").alias("value"))

    best = top_by(scores, "pagerank", 5).join(names.select("id", "name"), "id").select(
        F.concat(F.lit("top_"), F.col("rank").cast("string")).alias("metric"), F.col("name").alias("label"),
        F.col("pagerank").alias("value"),
    )
    # k + 1 rows.
    ends = timeline.agg(
        F.max_by("remaining_flow_pct", F.when(F.col("step") == 1, 1)).alias("first"),
        F.max_by("remaining_flow_pct", "step").alias("last"),
        F.min_by("num_components", "step").alias("before"),
        F.max_by("num_components", "step").alias("after"),
    )
    outcome = ends.select(F.explode(F.array(
        F.struct(F.lit("first_removal_loss").alias("metric"), (100.0 - F.col("first")).alias("value")),
        F.struct(F.lit("all_removals_loss").alias("metric"), (100.0 - F.col("last")).alias("value")),
        F.struct(F.lit("components_before").alias("metric"), F.col("before").cast("double").alias("value")),
        F.struct(F.lit("components_after").alias("metric"), F.col("after").cast("double").alias("value")),
    )).alias("r")).select("r.metric", F.lit("").alias("label"), "r.value")
    parts = [single(c, F.col(c)) for c in ("nodes", "edges", "flow", "communities")]
    return reduce(DataFrame.unionByName, [*parts, best, outcome])


def embedding_feed(points: DataFrame, features: DataFrame, labelled_upto: int = 15) -> DataFrame:
    """2-D position of every zone with community, rank, label flag and marker size."""
    largest = features.agg(F.max("pagerank")).scalar()
    return points.join(features, "id").select(
        "id", "x", "y", "community", "rank", (F.col("rank") <= labelled_upto).alias("labelled"),
        (30.0 + ratio_to_max(F.col("pagerank"), largest) * 250.0).alias("size"),
    )
