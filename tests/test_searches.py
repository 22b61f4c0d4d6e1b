"""Path searches leave no rounds behind, and trees of long sparse graphs need no search."""

import os
import random
from urllib.parse import urlparse

import numpy as np
import pytest

from flowatlas.operators import blocks, paths
from flowatlas.session import discard, settle, shared_root, store

SCHEMA = "src long, dst long, weight long"


def folders(spark):
    """Checkpoints and scratch tables that have files."""
    top = urlparse(shared_root(spark)).path
    return {d for d, _, files in os.walk(top) if any(f.startswith("part-") and not f.endswith(".crc") for f in files)}


def hops_of(edges, ids):
    near = {v: set() for v in ids}
    for a, b in edges:
        near[a].add(b)
    total = 0
    for v in ids:
        seen, line = {v: 0}, [v]
        for at in line:
            for to in near[at] - seen.keys():
                seen[to] = seen[at] + 1
                line.append(to)
        total += sum(seen.values())
    return total


def test_what_is_written_can_be_discarded(spark):
    before = folders(spark)
    for write in (settle, store):
        written = write(spark.range(5))
        assert folders(spark) - before
        discard(written)
        assert not folders(spark) - before
    discard(spark.range(5).filter("id > 1"))  # nothing was written


def test_rounds_leave_nothing_behind(spark, monkeypatch):
    """Nine vertices in a row: a search of many rounds."""
    for module, name, value in ((blocks, "CELLS", 10), (blocks, "EDGES_PER_UNIT", 3), (paths, "SOURCES", 2), (paths, "WORDS", 1)):
        monkeypatch.setattr(module, name, value)
    spark.sparkContext._jvm.System.gc()
    line = [(v, v + 1, 1) for v in range(8)]
    before = folders(spark)
    kept = [paths.betweenness(spark.createDataFrame(line, SCHEMA), rows_per_batch=90)]
    assert len(folders(spark) - before) < 20
    both = [*line, *[(b, a, w) for a, b, w in line]]
    before = folders(spark)
    kept.append(paths.total_hops(spark.createDataFrame(both, SCHEMA), spark.range(9)))
    assert kept[1].first()[0] == hops_of([(a, b) for a, b, _ in both], range(9))
    assert len(folders(spark) - before) < 20


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_hops_without_trees(spark, seed):
    """Cycles with trees on them, a tree, a lone edge and a lone vertex; then edges of one direction only."""
    rnd = random.Random(seed)
    pairs = {(v, (v + 1) % 7) for v in range(7)} | {(0, 3)} | {(v, rnd.randrange(v)) for v in range(7, 40)} | {(50 + v, 50 + (v - 1) // 2) for v in range(1, 20)} | {(90, 91)}
    pairs |= {(100, 101), (101, 102), (102, 100)}
    ids = sorted({v for p in pairs for v in p} | {99})
    both = pairs | {(b, a) for a, b in pairs}
    vertices = spark.createDataFrame([(v,) for v in ids], "id long")
    for edges in (both, pairs, [*both, *both, (3, 3)]):
        got = paths.total_hops(spark.createDataFrame([(a, b) for a, b in edges], "src long, dst long"), vertices).first()[0]
        assert got == hops_of([(a, b) for a, b in edges if a != b], ids)


def test_sparse_graph_of_many_vertices_is_searched_inside_tasks(spark, monkeypatch):
    """More vertices than a matrix of full width has rows: a cycle of 60 with a path of 60 on it."""
    monkeypatch.setattr(blocks, "CELLS", 150)
    edges = [(v, (v + 1) % 60) for v in range(60)] + [(v, v - 1 if v > 60 else 0) for v in range(60, 120)]
    both = [*edges, *[(b, a) for a, b in edges]]
    asked = []
    monkeypatch.setattr(paths, "_hops_outside", lambda *_: asked.append(1))
    got = paths.total_hops(spark.createDataFrame(both, "src long, dst long"), spark.range(120)).first()[0]
    assert not asked and got == hops_of(both, range(120))


def test_leaves_are_taken_off():
    edges = [(0, 1), (1, 2), (2, 0), (2, 3), (3, 4), (3, 5), (6, 7)]
    source, target = (np.array(x) for x in zip(*edges, *[(b, a) for a, b in edges]))
    hops, weight = paths._peel(source, target, 8)
    assert weight.tolist() == [1, 1, 4, 0, 0, 0, 0, 0]
    assert hops == 2 * (5 + 5 + 3 * 3) + 2
