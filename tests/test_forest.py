"""Spanning forests, removals counted from them, peeling, next rows and main routes against plain Python."""

import random

import brute
import pytest
from pyspark.sql import functions as F

from flowatlas.operators import components, graph, skew
from flowatlas.operators.ordering import following
from flowatlas.operators.removal import Removal

SCHEMA = "src long, dst long, weight long"


def groups_above(edges, ids, bound):
    return brute.weak([(a, b, w) for a, b, w in edges if w > bound], ids)


@pytest.mark.parametrize("seed", [1, 2])
def test_forest_connects_what_the_edges_connect(spark, layout, seed):
    edges = brute.random_graph(seed, n=16, m=30) + [(20, 21, 3), (21, 20, 5), (22, 22, 9)]
    ids = brute.vertices(edges)
    forest = [tuple(r) for r in components.spanning_forest(spark.createDataFrame(edges, SCHEMA), "weight").collect()]
    assert len(forest) == len(ids) - len(set(brute.weak(edges, ids).values()))
    assert {(a, b) for a, b, _ in forest} <= {(min(a, b), max(a, b)) for a, b, _ in edges}
    for bound in range(10):
        assert groups_above(forest, ids, bound) == groups_above(edges, ids, bound)


def test_forest_of_nothing(spark):
    assert components.spanning_forest(spark.createDataFrame([], SCHEMA), "weight").count() == 0
    assert components.spanning_forest(spark.createDataFrame([(1, 1, 2)], SCHEMA), "weight").count() == 0


@pytest.mark.parametrize("k", [1, 4, 30])
def test_components_of_all_steps(spark, k):
    edges = brute.random_graph(9, n=18, m=24)
    ids = brute.vertices(edges)
    scores = {v: (v * 7) % 19 for v in ids}
    removal = Removal(spark.createDataFrame(edges, SCHEMA), spark.createDataFrame([(v, float(s)) for v, s in scores.items()], "id long, pagerank double"), k)
    order = sorted(ids, key=lambda v: (-scores[v], v))[:k]
    want = {}
    for step in range(k + 1):
        left = [v for v in ids if v not in order[:step]]
        if left:
            kept = [(a, b, w) for a, b, w in edges if a in left and b in left]
            want[step] = len(set(brute.weak(kept, left).values()))
    assert {r["step"]: r["num_components"] for r in removal.components().collect()} == want
    if k == 4:
        names = spark.createDataFrame([(v, f"zone {v}") for v in ids], "id long, name string")
        rows = {r["step"]: r for r in removal.named_timeline(names, 2).collect()}
        assert rows[0]["removed_name"] is None and rows[0]["new_leaders"] is None
        assert [rows[s]["removed_name"] for s in range(1, 5)] == [f"zone {v}" for v in order]
        assert all(len(rows[s]["new_leaders"]) == 2 and rows[s]["removed_name"] not in rows[s]["new_leaders"] for s in range(1, 5))


def test_peeling(spark, layout):
    """A cycle with trees into it and out of it, and a cycle that the trees lead to."""
    edges = [(0, 1), (1, 2), (2, 0), (2, 3), (3, 4), (4, 5), (5, 6), (6, 4), (6, 7), (7, 8)] + [(10 + k, (10 + k) // 2 - 4) for k in range(8)]
    df = spark.createDataFrame(edges, "src long, dst long")
    ids = brute.vertices([(a, b, 1) for a, b in edges])
    left = {tuple(r) for r in components._trimmed(df).collect()}
    assert {(0, 1), (1, 2), (2, 0), (4, 5), (5, 6), (6, 4)} <= left <= set(edges) - {(7, 8), (6, 7)}
    assert {r["id"]: r["component"] for r in components.strong_components(df).collect()} == brute.strong([(a, b, 1) for a, b in edges], ids)


def test_trees_are_peeled_away_without_labels(spark, monkeypatch):
    monkeypatch.setattr(components, "_smallest_reaching", None)  # not needed
    tree = [(k, (k - 1) // 2) for k in range(1, 40)]
    found = components.strong_components(spark.createDataFrame(tree, "src long, dst long")).collect()
    assert sorted((r["id"], r["component"]) for r in found) == [(v, v) for v in range(40)]


def test_following_row(spark):
    """One group holds most rows and spreads over several partitions; groups of one row and null keys."""
    rnd = random.Random(4)
    rows = [(7, k, rnd.randrange(5)) for k in range(300)] + [(g, rnd.randrange(9), g) for g in range(6) for _ in range(3)] + [(50, 0, 1), (None, 1, 4), (None, 2, 5)]
    df = spark.createDataFrame(rows, "g long, o long, v long").withColumn("other", F.lit("x"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    got = following(df, ["g"], ["o", "v"], "v", "next")
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got.columns == ["g", "o", "v", "other", "next"]
    want = []
    for g in {r[0] for r in rows}:
        own = sorted(r[1:] for r in rows if r[0] == g)
        want += [(g, *x, "x", y[1] if y else None) for x, y in zip(own, [*own[1:], None])]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert following(df.limit(0), ["g"], ["o"], "v", "next").count() == 0


def test_main_routes(spark):
    edges = spark.createDataFrame([(1, 2, 5), (1, 3, 7), (2, 1, 4), (2, 3, 4), (3, 1, 1)], SCHEMA)
    routes = {tuple(r) for r in graph.main_routes(edges).collect()}
    assert {(1, 3, 7), (3, 1, 1)} <= routes and len(routes) == 3 and len(routes & {(2, 1, 4), (2, 3, 4)}) == 1
    assert {tuple(r)[:2] for r in graph.returning(graph.main_routes(edges)).collect()} == {(1, 3), (3, 1)}


def test_sparse_forests_are_not_broadcast(spark, monkeypatch):
    """Labels that are about as many as the edges are shuffled: a broadcast of them would pass through the driver in every round."""
    monkeypatch.setattr(skew, "SMALL_ROWS", 0)
    asked, plain = [], components.join_unique

    def seen(big, small, on, rows=None, how="inner", big_rows=None):
        asked.append(rows <= skew.BROADCAST_ROWS if big_rows is None else skew.worth_broadcasting(rows, big_rows))
        return plain(big, small, on, rows, how, big_rows)

    monkeypatch.setattr(components, "join_unique", seen)
    edges = [(v, v * 7 % 31, v % 5) for v in range(31)]
    components.spanning_forest(spark.createDataFrame(edges, SCHEMA), "weight").collect()
    assert asked and not any(asked)
