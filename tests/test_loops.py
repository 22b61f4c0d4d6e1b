"""Iterative operators against plain Python, on graphs with a hot source, in both join layouts."""

import brute
import pytest
from pyspark.sql import functions as F

from flowatlas.operators import community, components, paths, rank, skew
from flowatlas.operators.adjacency import Adjacency, vertex_ids
from flowatlas.operators.rank import pagerank
from flowatlas.operators.removal import Removal

SCHEMA = "src long, dst long, weight long"


@pytest.fixture
def graph(spark):
    edges = brute.random_graph(2, m=26)
    return edges, brute.vertices(edges), spark.createDataFrame(edges, SCHEMA)


def as_map(df, value):
    return {r["id"]: r[value] for r in df.collect()}


def test_pagerank(graph, layout):
    edges, ids, df = graph
    weighted = layout == "broadcast"
    assert as_map(pagerank(df, weighted=weighted, max_iter=8), "pagerank") == pytest.approx(
        brute.pagerank(edges, ids, rounds=8, weighted=weighted), abs=1e-12)


def test_pagerank_stops_and_scales(graph):
    edges, ids, df = graph
    exact = brute.pagerank(edges, ids, rounds=300)
    assert as_map(pagerank(df, max_iter=200, tol=1e-4), "pagerank") == pytest.approx(exact, abs=1e-2)
    scaled = as_map(pagerank(df, max_iter=2, scale="n"), "pagerank")
    assert sum(scaled.values()) == pytest.approx(len(ids))


def test_keyed_pagerank_runs_graphs_side_by_side(spark):
    one, two = brute.random_graph(3), brute.random_graph(4)
    rows = [(1, *e) for e in one] + [(2, *e) for e in two]
    df = spark.createDataFrame(rows, "step int, " + SCHEMA)
    scores = pagerank(df, keys=("step",), max_iter=5).collect()
    for step, edges in ((1, one), (2, two)):
        got = {r["id"]: r["pagerank"] for r in scores if r["step"] == step}
        assert got == pytest.approx(brute.pagerank(edges, brute.vertices(edges), rounds=5), abs=1e-12)


def test_components(graph, layout):
    edges, ids, df = graph
    assert as_map(components.weak_components(df), "component") == brute.weak(edges, ids)


def test_strong_components(graph, layout):
    edges, ids, df = graph
    assert as_map(components.strong_components(df), "component") == brute.strong(edges, ids)


def test_long_chain_is_one_component(spark):
    n = 200
    chain = spark.range(n - 1).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"), F.lit(1).alias("weight"))
    assert components.weak_components(chain).select("component").distinct().collect()[0][0] == 0
    assert components.strong_components(chain).select("component").distinct().count() == n


def test_label_propagation(graph, layout):
    edges, ids, df = graph
    assert as_map(community.label_propagation(df), "label") == brute.labels(edges, ids)


def test_betweenness_in_both_layouts(graph, layout):
    edges, ids, df = graph
    got = as_map(paths.betweenness(df), "betweenness")
    assert got == pytest.approx(brute.betweenness(edges, ids, lambda w: w), abs=1e-12)


@pytest.mark.parametrize("cost, price", [("hops", lambda w: 1), ("inverse", lambda w: 1 / w)])
def test_betweenness_costs(graph, cost, price):
    edges, ids, df = graph
    if cost == "inverse":
        # powers of two keep sums exact, so ties are the same in both
        edges = [(a, b, 2 ** (w % 3)) for a, b, w in edges]
        df = df.sparkSession.createDataFrame(edges, SCHEMA)
    got = as_map(paths.betweenness(df, cost=cost), "betweenness")
    assert got == pytest.approx(brute.betweenness(edges, ids, price), abs=1e-12)


def test_sampled_betweenness_uses_its_pivots(graph):
    edges, ids, df = graph
    chosen = [r["id"] for r in paths.pivots(vertex_ids(df), 5).collect()]
    got = as_map(paths.betweenness(df, sample=5), "betweenness")
    assert got == pytest.approx(brute.betweenness(edges, ids, lambda w: w, chosen), abs=1e-12)


def test_betweenness_stays_exact_on_larger_graphs(spark):
    """400 chains of three: 1,200 vertices, sources in several batches, only the middles lie between others."""
    chains = [(3 * k, 3 * k + 1, 1) for k in range(400)] + [(3 * k + 1, 3 * k + 2, 1) for k in range(400)]
    got = as_map(paths.betweenness(spark.createDataFrame(chains, SCHEMA), cost="hops", rows_per_batch=500_000), "betweenness")
    assert got == pytest.approx({v: (v % 3 == 1) / (1199 * 1198) for v in range(1200)}, abs=1e-15)


@pytest.mark.parametrize("rows_per_batch", [80, 10**9])
def test_average_path(graph, rows_per_batch):
    edges, ids, df = graph
    row = paths.average_path_length(df, rows_per_batch=rows_per_batch).first()
    size, mean = brute.average_hops(edges, ids)
    assert (row["core_size"], row["avg_path"]) == (size, pytest.approx(mean))


def test_hot_source_is_split(spark, layout):
    star = spark.range(1, 31).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"))
    links = Adjacency(star, 1000)
    sent = links.push(spark.createDataFrame([(0, 1.0)], "id long, y double"))
    assert sent.count() == 30
    if layout == "shuffled":
        assert links.mode == "shuffle"
        assert links.edges.groupBy("src", "_part").count().agg(F.max("count")).first()[0] < 10
    links.release()


def test_louvain_separates_cliques(spark):
    clique = [(a, b, 5) for base in (0, 10, 20) for a in range(base, base + 5) for b in range(base, base + 5) if a < b]
    df = spark.createDataFrame(clique + [(0, 10, 1), (10, 20, 1)], SCHEMA)
    groups = community.louvain(df).cache()
    assert as_map(groups, "label") == {v: v // 10 * 10 for v in range(25) if v % 10 < 5}
    single = vertex_ids(df).select("id", F.col("id").alias("label"))
    assert community.modularity(df, groups).first()[0] > 0.6 > community.modularity(df, single).first()[0]


def test_louvain_is_the_same_in_both_layouts(spark, monkeypatch):
    edges = brute.random_graph(5, n=9, m=14)
    df = spark.createDataFrame(edges, SCHEMA)
    first = as_map(community.louvain(df), "label")
    assert sorted(first) == brute.vertices(edges)
    monkeypatch.setattr(skew, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(skew, "ROWS_PER_PART", 3)
    assert as_map(community.louvain(df), "label") == first


def quality(links, label, whole):
    total, inside = {}, 0.0
    for (a, b), w in links.items():
        total[label[a]] = total.get(label[a], 0) + w
        inside += w * (label[a] == label[b])
    return inside / whole - sum(t * t for t in total.values()) / whole ** 2


@pytest.mark.parametrize("seed, last_share", [(6, 1 / 64), (7, 1.0)])
def test_louvain_rounds_rise_to_a_local_optimum(spark, monkeypatch, seed, last_share):
    """Also where all moves are made apart from each other (``last_share`` above the first share)."""
    monkeypatch.setattr(community, "LAST_SHARE", last_share)
    links = {}
    for a, b, w in brute.random_graph(seed, n=20, m=60):
        links[a, b] = links.get((a, b), 0) + w
        links[b, a] = links.get((b, a), 0) + w
    whole = float(sum(links.values()))
    df = spark.createDataFrame([(a, b, float(w)) for (a, b), w in links.items()], "src long, dst long, w double")
    groups, values = community.local_moves(df, whole, "s", 1e-9)
    label = as_map(groups, "label")
    assert all(x < y for x, y in zip(values, values[1:])) and len(values) > 1
    assert values[0] == pytest.approx(quality(links, {v: v for v in label}, whole))
    assert values[-1] == pytest.approx(quality(links, label, whole))
    for v in label:
        for other in set(label.values()):
            assert quality(links, {**label, v: other}, whole) <= values[-1] + 1e-8


def test_empty_graph(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert pagerank(df).count() == 0
    assert components.weak_components(df).count() == 0
    assert components.strong_components(df).count() == 0
    assert community.label_propagation(df).count() == 0
    assert community.louvain(df).count() == 0
    assert paths.betweenness(df).count() == 0


def test_louvain_round_is_one_pass_over_packed_edges(spark, monkeypatch):
    """Same moves and figures as by joins, from several units, with null ends and weights; a round takes few jobs."""
    monkeypatch.setattr(community, "EDGES_PER_TASK", 40)
    links = {}
    for a, b, w in brute.random_graph(8, n=30, m=120):
        links[a, b] = links.get((a, b), 0) + w
        links[b, a] = links.get((b, a), 0) + w
    rows = [(a, b, float(w)) for (a, b), w in links.items()] + [(3, None, 2.0), (None, 3, 2.0), (4, 400, None), (400, 4, None)]
    df = spark.createDataFrame(rows, "src long, dst long, w double").cache()
    whole, context = float(sum(w for *_, w in rows if w)), spark.sparkContext
    single = df.groupBy(F.col("src").alias("id")).agg(F.sum("w").alias("k")).cache()
    state = single.select("id", "k", F.least(F.col("id"), F.col("id") % 7).alias("label"))
    found, jobs = [], []
    for number, make in enumerate((community._weigh_joined, community._weigh_packed)):
        weigh, release = make(df, single, single.count(), whole, 0.0, 1e-9)
        context.setJobGroup(f"round-{number}", "a round")
        picked, value, movers = weigh(state)
        jobs.append(len(context.statusTracker().getJobIdsForGroup(f"round-{number}")))
        context.setLocalProperty("spark.jobGroup.id", None)
        gains = {r["id"]: (r["own"], r["target"], round(r["gain"], 12)) for r in picked.collect() if (r["gain"] or 0) > 1e-9}
        found.append((gains, round(value, 12), movers))
        release()
    assert found[0] == found[1] and len(found[0][0]) == found[0][2] > 5
    assert jobs[1] < jobs[0]


@pytest.mark.parametrize("weighted", [False, True])
def test_scores_of_all_steps_need_no_copies_of_the_edges(spark, monkeypatch, weighted):
    """Scores of steps side by side in one row equal those of a copy of the graph per step; edges meet a state once, not once per step."""
    edges = brute.random_graph(11, n=14, m=40)
    df, ids = spark.createDataFrame(edges, "src long, dst long, weight long"), brute.vertices(edges)
    removal = Removal(df, spark.createDataFrame([(v, float((v * 5) % 13)) for v in ids], "id long, pagerank double"), 4)
    copies = rank.pagerank(removal._alive(removal.edges, 1), weighted=weighted, max_iter=3, vertices=removal._alive(removal.vertices, 1), keys=("step",))
    want = {(r["step"], r["id"]): r["pagerank"] for r in copies.collect()}
    laid, plain = [], rank.Adjacency

    def counted(edges, *args):
        laid.append(edges.count())
        return plain(edges, *args)

    monkeypatch.setattr(rank, "Adjacency", counted)
    monkeypatch.setattr(rank, "STEPS_AT_ONCE", 3)
    got = {(r["step"], r["id"]): r["pagerank"] for r in rank.pagerank_lasting(removal.edges, removal.vertices, range(1, 5), weighted, 3).collect()}
    assert got == pytest.approx(want) and max(laid) <= len(edges)
