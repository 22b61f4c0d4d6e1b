"""Time the headline queries; print one JSON line.

``BENCH_SF_DIR`` (tables), ``BENCH_CPUS`` (local threads), ``BENCH_QUERIES`` and ``BENCH_COPIES`` (0: no scale run) come
from the environment.
``trips_at_scale`` cleans and aggregates the trip table repeated until it has about as many rows as the
published run of the reference (38.3 million), read back from Parquet.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from flowatlas.operators import cleaning, community, components, graph  # noqa: E402
from flowatlas.operators.adjacency import vertex_ids  # noqa: E402
from flowatlas.operators.rank import pagerank  # noqa: E402
from flowatlas.operators.removal import Removal  # noqa: E402
from flowatlas.operators import paths, report  # noqa: E402
from flowatlas.plans import fixtures  # noqa: E402
from flowatlas.plans.catalogue import QUERIES  # noqa: E402
from flowatlas.session import build_session, scratch_path, settle  # noqa: E402

HEADLINE = os.environ.get(
    "BENCH_QUERIES",
    "od_edges_base cleaning_report filter_ablation graph_stats pagerank_weighted label_propagation betweenness_hops wcc_whole scc_whole summary_report",
).split()


def analysis(trips, zones):
    """Clean, aggregate, rank, search paths, group, remove, summarise: the published end-to-end run without its plots."""
    edges = settle(cleaning.od_edges(trips))
    vertices = settle(graph.named_vertices(vertex_ids(edges), zones))
    scores = settle(pagerank(edges))
    groups = settle(community.numbered(community.label_propagation(edges)))
    settle(paths.betweenness(edges))
    settle(paths.average_path_length(edges))
    settle(components.strong_components(edges))
    settle(community.louvain(edges))
    stats = report.full_stats(edges, components.weak_components(edges), groups)
    timeline = settle(Removal(edges, scores).timeline(paths=False))
    return report.summary_report(stats, scores, vertices, timeline)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    copies = int(os.environ.get("BENCH_COPIES", "64"))
    spark = build_session("flowatlas-bench", f"local[{cpus}]", int(cpus),
                          **{"spark.driver.memory": "16g", "spark.ui.enabled": "false",
                             "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["od_edges_base"](spark, sf_dir).collect()  # first use loads classes and compiles
    seconds = {}
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, sf_dir).collect()
        seconds[name] = round(time.time() - start, 3)
    extra = {}
    if copies:
        path = scratch_path(spark, "trips.parquet")
        repeated = fixtures.trips(spark, sf_dir).repartition(2 * int(cpus)).selectExpr("*", f"explode(sequence(1, {copies})) AS copy").drop("copy")
        repeated.write.parquet(path)
        trips = spark.read.parquet(path)
        rows = trips.count()
        start = time.time()
        cleaning.od_edges(trips).collect()
        seconds["trips_at_scale"] = round(time.time() - start, 3)
        start = time.time()
        analysis(trips, fixtures.zones(spark, sf_dir)).collect()
        seconds["analysis_at_scale"] = round(time.time() - start, 3)
        extra = {"scale_rows": rows, "scale_rows_per_sec": round(rows / seconds["analysis_at_scale"])}
    print(json.dumps({"metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")), **extra}))
    spark.stop()


if __name__ == "__main__":
    main()
