"""Nearest neighbours against brute force."""

import numpy as np
import pytest

from flowatlas.llm import neighbours


def brute(x, ids, queries, k):
    u = neighbours.unit(x)
    s = u[queries] @ u.T
    s[np.arange(len(queries)), queries] = -2
    return [ids[np.lexsort([ids, -row])[:k]].tolist() for row in s]


def frame(spark, ids, x):
    return spark.createDataFrame([(int(i), v.tolist(), "z", "z", 1.0) for i, v in zip(ids, x)], "vec_id long, embedding array<float>, d string, vector string, score double")


@pytest.mark.parametrize("shard,block", [(100_000, 100_000), (700, 20)])
def test_recall(spark, monkeypatch, shard, block):
    monkeypatch.setattr(neighbours, "SHARD", shard)
    rnd = np.random.default_rng(11)
    x = rnd.standard_normal((2400, 64))
    x[500:900] = x[500] + 0.05 * rnd.standard_normal((400, 64))  # near copies
    x[900:1200] = x[900]  # copies
    x = x.astype(np.float32).astype(np.float64)
    ids = rnd.permutation(10_000)[:2400]
    rows = neighbours.vectors(frame(spark, ids, x))
    asked = ids[ids % 10 == 0]
    got = {}
    for r in neighbours.search(neighbours.build_index(rows), rows.filter("vec_id % 10 = 0"), block=block).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == sorted(asked.tolist())
    place = {int(i): k for k, i in enumerate(ids)}
    hits = 0
    for q, near in zip(asked.tolist(), brute(x, ids, [place[int(i)] for i in asked], 5)):
        found = sorted(got[q])
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5] and q not in [i for _, i, _ in found]
        assert found == sorted(found, key=lambda f: (-f[2], f[1]))
        for _, i, s in found:
            a, b = x[place[q]], x[place[i]]
            assert abs(s - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12
        hits += len({i for _, i, _ in found} & set(near))
        if 900 <= place[q] < 1200:  # ties of copies go to the smallest ids
            assert [i for _, i, _ in found] == near
    assert hits >= 0.95 * 5 * len(asked)


def test_ascent_stops_early_for_near_copies():
    rnd = np.random.default_rng(2)
    x = neighbours.unit(np.concatenate([rnd.standard_normal((3000, 32)), np.repeat(rnd.standard_normal((1, 32)), 10, 0) + 0.01 * rnd.standard_normal((10, 32))]))
    forest = neighbours.Forest.build(np.arange(3010), x)
    compared = []
    best = forest.best
    forest.best = lambda q, own, rows, k: compared.append(len(rows)) or best(q, own, rows, k)
    at, found, scores = neighbours.ascent(forest, np.array([3005]), x[3005:3006], np.array([-np.inf]), 5)
    assert set(found) <= set(range(3000, 3010)) and len(found) == 5
    assert sum(compared) < 100
    assert neighbours.stop_length(1.0) == neighbours.BITS and neighbours.stop_length(-1.0) == 0
    p = 1 - np.arccos(0.5) / np.pi
    n = neighbours.stop_length(0.5)
    assert (1 - p ** n) ** neighbours.TREES <= neighbours.MISS < (1 - p ** (n + 1)) ** neighbours.TREES


def test_prefixes():
    a = np.array([0, 1, 1 << 63, (1 << 64) - 1, 0, 1 << 32, 1 << 31], np.uint64)
    b = np.array([0, 0, 0, 0, 1 << 40, 0, 0], np.uint64)
    assert neighbours._prefix_length(a, b).tolist() == [64, 63, 0, 0, 23, 31, 32]


def test_awkward_rows(spark):
    schema = "vec_id long, embedding array<double>"
    data = [(0, [1.0, 0.0]), (50, [0.0, 0.0]), (100, None), (150, [1.0, None]), (200, [float("nan"), 1.0]), (1, [1e200, 1e200]), (2, [-1.0, 0.0]), (3, [1e-200, 0.0]),
            (None, [1.0, 0.0]), (250, [1.0, 2.0, 3.0]), (300, []), (3, [1e-200, 0.0]), (3, [1.0, 1.0]), (350, [2.0, 0.0])]
    rows = neighbours.vectors(spark.createDataFrame(data, schema))
    got = [tuple(r) for r in neighbours.search(neighbours.build_index(rows), rows.filter("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()]
    kept = 0.5 ** 0.5 if min(np.array([1e-200, 0.0]).tobytes(), np.array([1.0, 1.0]).tobytes()) == np.array([1.0, 1.0]).tobytes() else 1.0
    third = sorted([(-1.0, 350), (-kept, 3), (-(0.5 ** 0.5), 1), (1.0, 2)])
    other = sorted([(-1.0, 0), (-kept, 3), (-(0.5 ** 0.5), 1), (1.0, 2)])
    want = [(0, k + 1, i, -s) for k, (s, i) in enumerate(third)] + [(350, k + 1, i, -s) for k, (s, i) in enumerate(other)]
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) < 1e-12 for g, w in zip(got, want))
    none = neighbours.vectors(spark.createDataFrame([], schema))
    assert neighbours.search(neighbours.build_index(none), none).count() == 0
