"""Path searches as matrices of chunks and blocks against plain Python, in one unit and in many."""

import brute
import pytest
from pyspark.sql import functions as F

from flowatlas.operators import blocks, paths
from flowatlas.operators.adjacency import vertex_ids
from flowatlas.operators.removal import Removal

SCHEMA = "src long, dst long, weight long"


@pytest.fixture
def many(monkeypatch):
    """Several chunks, parts of their edges, pieces of a run, and blocks of two sources."""
    monkeypatch.setattr(blocks, "CELLS", 10)
    monkeypatch.setattr(blocks, "EDGES_PER_UNIT", 3)
    monkeypatch.setattr(blocks, "STEP_CELLS", 2)
    monkeypatch.setattr(paths, "SOURCES", 2)
    monkeypatch.setattr(paths, "WORDS", 1)


def test_betweenness_over_many_units(spark, many):
    edges = brute.random_graph(5, n=9, m=16)
    df = spark.createDataFrame([*edges, (3, None, 1), (None, 4, 2)], SCHEMA)
    got = {r["id"]: r["betweenness"] for r in paths.betweenness(df.dropna(), rows_per_batch=90).collect()}
    assert got == pytest.approx(brute.betweenness(edges, brute.vertices(edges), lambda w: w), abs=1e-12)
    # A null end is a vertex that no path passes.
    nulls = {r["id"]: r["betweenness"] for r in paths.betweenness(df).collect()}
    n = len(got)
    assert nulls.pop(None) == 0.0
    assert nulls == pytest.approx({v: b * (n - 1) * (n - 2) / (n * (n - 1)) for v, b in got.items()}, abs=1e-12)


def test_betweenness_makes_no_row_per_pair(spark, monkeypatch):
    """100 vertices to 5 to 100: 1,000 edges, 11,000 pairs with a path."""
    rows = []
    for module in (paths, blocks):
        monkeypatch.setattr(module, "settle", lambda df, real=module.settle: rows.append((out := real(df)).count()) or out)
    edges = [(a, 100 + b, 1) for a in range(100) for b in range(5)] + [(100 + b, 105 + c, 1) for b in range(5) for c in range(100)]
    got = {r["id"]: r["betweenness"] for r in paths.betweenness(spark.createDataFrame(edges, SCHEMA)).collect()}
    assert got == pytest.approx({v: 2_000 / (204 * 203) if 100 <= v < 105 else 0.0 for v in range(205)}, abs=1e-12)
    assert max(rows) <= 1_000


def test_repeated_edges_are_paths_of_their_own(spark):
    edges = spark.createDataFrame([(0, 1, 1), (0, 1, 1), (0, 2, 1), (1, 3, 1), (2, 3, 1)], SCHEMA)
    got = {r["id"]: r["betweenness"] for r in paths.betweenness(edges).collect()}
    assert got == pytest.approx({0: 0.0, 1: 2 / 3 / 6, 2: 1 / 3 / 6, 3: 0.0})


@pytest.mark.parametrize("units", ["one", "many"])
def test_hops_of_a_long_path_need_no_job_per_hop(spark, request, units):
    """A path of 70 vertices and one of 3, side by side."""
    if units == "many":
        request.getfixturevalue("many")
    n = 70 if units == "one" else 9
    line = spark.range(n - 1).select(F.lit(1).alias("step"), F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    short = spark.range(2).select(F.lit(2).alias("step"), F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    both = line.unionByName(short)
    hops = both.unionByName(both.select("step", F.col("dst").alias("src"), F.col("src").alias("dst")))
    spark.sparkContext.setJobGroup("hops", units)
    totals = {r["step"]: r["total"] for r in paths.total_hops(hops, vertex_ids(both, ("step",)), ("step",)).collect()}
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("hops"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert totals == {1: (n - 1) * n * (n + 1) // 3, 2: 8}
    assert units == "many" or jobs < 70


@pytest.mark.parametrize("units", ["one", "many"])
def test_edges_of_all_removal_steps_are_packed_once(spark, request, monkeypatch, units):
    if units == "many":
        request.getfixturevalue("many")
    packs, real = [], blocks.settle

    def counted(df):
        out = real(df)
        packs.append(out.count() if "s" in out.columns else 0)
        return out

    monkeypatch.setattr(blocks, "settle", counted)
    edges = brute.random_graph(9, n=14, m=24) + [(3, 3, 2)]
    ids = brute.vertices(edges)
    scores = {v: (v * 7) % 15 for v in ids}
    df = spark.createDataFrame([*edges, (5, None, 1)], SCHEMA)
    ranked = spark.createDataFrame([(v, float(x)) for v, x in scores.items()], "id long, pagerank double")
    got = {r["step"]: (r["core_size"], r["avg_path"]) for r in Removal(df, ranked, 6).paths().collect()}
    order = sorted(ids, key=lambda v: (-scores[v], v))
    for step in range(7):
        gone = set(order[:step])
        left = [(a, b, w) for a, b, w in edges if a not in gone and b not in gone]
        near = {v: set() for v in ids if v not in gone}
        for a, b, _ in left:
            near[a].add(b)
            near[b].add(a)
        groups = {}
        for v, c in brute.weak(left, list(near)).items():
            groups.setdefault(c, []).append(v)
        core = max(groups.values(), key=lambda g: (len(g), -min(g)))
        total = 0
        for v in core:
            seen, line = {v: 0}, [v]
            for at in line:
                for to in near[at] - seen.keys():
                    seen[to] = seen[at] + 1
                    line.append(to)
            total += sum(seen.values())
        n = len(core)
        assert got[step] == (n, pytest.approx(total / (n * (n - 1))) if n > 1 else None), step
    assert units == "many" or max(packs) == 1
