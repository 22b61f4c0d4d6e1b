"""The whole analysis as one job: every table is written to a run folder, and a manifest written last publishes the run.

A stage is a name and a function from the tables written so far to a new one. Its table is written first and then noted, as a one-row table of its
own, so the note of a stage is there only when the table is whole. A run that failed goes on behind the last noted stage when it is started again with the same
folder; a table without a note is written anew. Readers ask for the manifest and never see half a run. All files go through Spark's writers,
so the folder may be in any store that the cluster reaches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowatlas.operators import cleaning, community, components, graph, paths, report
from flowatlas.operators.adjacency import vertex_ids
from flowatlas.operators.rank import pagerank
from flowatlas.operators.removal import Removal

Tables = dict[str, DataFrame]
Stage = tuple[str, Callable[[Tables], DataFrame]]
NOTE = "position int, name string, path string, rows long, columns array<string>"


def _note(spark: SparkSession, path: str) -> list:
    """Rows of a note or manifest; none if it was not written whole."""
    try:
        return spark.read.schema(NOTE).json(path).collect()  # one row per stage at most
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def run_stages(spark: SparkSession, folder: str, stages: list[Stage]) -> Tables:
    """Write the table of every stage below ``folder``, skipping those an earlier attempt has finished, then the manifest."""
    if len({name for name, _ in stages}) != len(stages):
        raise ValueError("stages need different names")
    tables: Tables = {}
    for position, (name, stage) in enumerate(stages):
        path, note = f"{folder}/{name}.parquet", f"{folder}/_notes/{position}_{name}"
        if not _note(spark, note):
            stage(tables).write.mode("overwrite").parquet(path)
            written = spark.read.parquet(path)
            spark.createDataFrame([(position, name, path, written.count(), written.columns)], NOTE).coalesce(1).write.mode("overwrite").json(note)
        tables[name] = spark.read.parquet(path)
    notes = [row for position, (name, _) in enumerate(stages) for row in _note(spark, f"{folder}/_notes/{position}_{name}")]
    spark.createDataFrame(notes, NOTE).coalesce(1).write.mode("overwrite").json(f"{folder}/_manifest")
    return tables


def read_run(spark: SparkSession, folder: str) -> Tables:
    """The tables of a published run; an error if the run has not come to its end."""
    rows = _note(spark, f"{folder}/_manifest")
    if not rows:
        raise ValueError(f"no finished run in {folder}")
    return {row["name"]: spark.read.parquet(row["path"]) for row in sorted(rows, key=lambda r: r["position"])}


def analysis_stages(trips: DataFrame, zones: DataFrame, profile: str = "base", min_trips: int = 50, removals: int = 5) -> list[Stage]:
    """Trips to edges, ranks, centralities, communities, components, removals and the report tables."""
    return [
        ("edges", lambda t: cleaning.od_edges(trips, profile, min_trips)),
        ("vertices", lambda t: graph.named_vertices(vertex_ids(t["edges"]), zones)),
        ("scores", lambda t: pagerank(t["edges"])),
        ("betweenness", lambda t: paths.betweenness(t["edges"])),
        ("communities", lambda t: community.numbered(community.label_propagation(t["edges"]))),
        ("components", lambda t: components.weak_components(t["edges"])),
        ("timeline", lambda t: Removal(t["edges"], t["scores"], removals).named_timeline(t["vertices"])),
        ("node_features", lambda t: report.node_features(t["edges"], zones, t["scores"], t["betweenness"], t["communities"])),
        ("edge_features", lambda t: report.edge_features(t["edges"], zones)),
        ("community_summary", lambda t: community.community_summary(t["communities"].select("id", "label"), t["scores"], t["vertices"])),
        ("stats", lambda t: report.full_stats(t["edges"], t["components"], t["communities"])),
        ("summary", lambda t: report.summary_report(t["stats"], t["scores"], t["vertices"], t["timeline"])),
    ]


def inventory(tables: Tables, measures: dict[str, str]) -> DataFrame:
    """``(name, rows, total)``: rows of each table and the sum of one of its columns."""
    parts = [tables[name].agg(F.lit(name).alias("name"), F.count("*").alias("rows"), F.sum(F.expr(measure)).cast("double").alias("total"))
             for name, measure in measures.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
