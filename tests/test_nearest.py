"""Nearest vectors of all vertices against brute force."""

import numpy as np
import pytest

from flowatlas.operators import nearest
from flowatlas.sources import sinks

SCHEMA = "id long, vector array<double>"


def brute(rows, k):
    """Neighbours by cosine in single precision, then id."""
    kept = [(i, np.array(v)) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for i, v in kept:
        scored = [(-np.float32(v @ w / np.linalg.norm(v) / np.linalg.norm(w)), j) for j, w in kept if j != i]
        out[i] = [(j, -s) for s, j in sorted(scored)[:k]]
    return out


def planted(seed=5, n=150, dims=8):
    """Clusters, a third of all rows with the same vector, opposite and useless vectors."""
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(6, dims)) * 4
    rows = [(int(i * 3 - 100), (centres[i % 6] + rnd.normal(size=dims) * 0.3).tolist()) for i in range(n)]
    same = rnd.integers(1, 5, size=dims).astype(float).tolist()
    rows += [(5000 + i, same) for i in range(n // 2)] + [(9000, [-x for x in same])]
    bad = [None, [0.0] * dims, [None] + [1.0] * (dims - 1), [float("nan")] + [1.0] * (dims - 1), [float("inf")] + [1.0] * (dims - 1)]
    return rows + [(9100 + i, v) for i, v in enumerate(bad)]


def grouped(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r["anchor"], r["place"])):
        got.setdefault(r["anchor"], []).append(r)
        assert r["place"] == len(got[r["anchor"]])
    return got


@pytest.mark.parametrize("block,size,products,pivots", [(2**20, 1024, 2**22, 32), (160, 7, 50, 5), (400, 16, 2**22, 1)])
def test_nearest_of_all(spark, monkeypatch, block, size, products, pivots):
    for name, value in {"BLOCK_VALUES": block, "SLICE": size, "PRODUCTS": products, "PIVOTS": pivots}.items():
        monkeypatch.setattr(nearest, name, value)
    rows = planted()
    got, want = grouped(nearest.nearest_vectors(spark.createDataFrame(rows, SCHEMA), 4)), brute(rows, 4)
    assert got.keys() == want.keys()
    for i, expected in want.items():
        assert [r["similarity"] for r in got[i]] == pytest.approx([s for _, s in expected], abs=1e-6)
        if i >= 5000 and i < 9000:  # all neighbours are copies: smallest ids first
            assert [r["id"] for r in got[i]] == [j for j, _ in expected]
        elif len({s for _, s in expected}) == 4 and i < 5000:
            assert [r["id"] for r in got[i]] == [j for j, _ in expected]


def test_pruned_slices_are_not_multiplied(spark, monkeypatch):
    """Rows far from all queries of a block are not compared: the bounds come from the pivots."""
    rnd = np.random.default_rng(2)
    centres = np.eye(6) * 5
    rows = np.concatenate([c + rnd.normal(size=(40, 6)) * 0.05 for c in centres])
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    pivots = nearest._choose_pivots(rows[:: 7])
    products = []
    add = nearest.Best.add
    monkeypatch.setattr(nearest.Best, "add", lambda self, at, s, ids: (products.append(s.size), add(self, at, s, ids)))
    import pyarrow as pa

    class Shared:
        value = (np.arange(40), rows[:40], np.full(40, 0.9))

    batches = [pa.RecordBatch.from_arrays([pa.array(np.arange(40 * c, 40 * c + 40)), pa.array(rows[40 * c:40 * c + 40].tolist())], names=["id", "vector"]) for c in range(6)]
    list(nearest._search(Shared, pivots, 3)(batches))
    assert sum(products) == 40 * 40


def test_fewer_rows_than_asked_and_none(spark):
    few = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, None)], SCHEMA)
    assert {i: [r["id"] for r in rows] for i, rows in grouped(nearest.nearest_vectors(few)).items()} == {1: [2], 2: [1]}
    assert nearest.nearest_vectors(few.filter("id = 3")).count() == 0
    assert nearest.nearest_vectors(few.filter("id = 1")).count() == 0
    with pytest.raises(ValueError, match="components"):
        nearest.nearest_vectors(spark.createDataFrame([(1, [1.0]), (2, [1.0, 1.0])], SCHEMA))


def test_vectors_and_neighbours_are_written(spark, tmp_path):
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 2.0])], SCHEMA)
    path = sinks.write_vectors(vectors, nearest.nearest_vectors(vectors, 1), str(tmp_path / "model"))
    again, pairs = sinks.read_vectors(spark, path)
    assert {r["id"]: r["vector"] for r in again.collect()} == {1: [1.0, 0.0], 2: [1.0, 1.0], 3: [0.0, 2.0]}
    assert {(r["anchor"], r["id"]) for r in pairs.collect()} == {(1, 2), (2, 1), (3, 2)}
