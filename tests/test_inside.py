"""Components and forests that one task finds are those of the distributed rounds, nulls included."""

import brute
import pytest

from flowatlas.operators import components, inside as one_task, skew

SCHEMA = "src long, dst long, weight long"


def both(monkeypatch, work):
    """The rows found in one task and by rounds of jobs."""
    inside = sorted(map(tuple, work().collect()), key=repr)
    with monkeypatch.context() as m:
        m.setattr(skew, "SMALL_ROWS", 0)
        m.setattr(skew, "BROADCAST_ROWS", 0)
        assert not skew.fits_task(1)
        return inside, sorted(map(tuple, work().collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_weak_components(spark, monkeypatch, seed):
    edges = [*brute.random_graph(seed, n=40, m=30), (5, None, 1), (None, 6, 1), (None, None, 2), (50, 50, 1)]
    df = spark.createDataFrame(edges, SCHEMA)
    inside, rounds = both(monkeypatch, lambda: components.weak_components(df))
    assert inside == rounds
    plain = [e for e in edges if None not in e]
    want = brute.weak(plain, brute.vertices(plain))
    assert dict(inside).items() >= want.items()


def test_components_of_several_graphs(spark, monkeypatch):
    rows = [(k, *e) for k in (3, 9) for e in brute.random_graph(k, n=20, m=14)] + [(None, 1, 2, 3), (3, None, 4, 1)]
    df = spark.createDataFrame(rows, f"step int, {SCHEMA}")
    inside, rounds = both(monkeypatch, lambda: components.weak_components(df, keys=("step",)))
    assert inside == rounds and {r[0] for r in inside} == {3, 9}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_strong_components(spark, monkeypatch, seed):
    edges = [*brute.random_graph(seed, n=30, m=45), (5, None, 1), (7, 7, 2)]
    df = spark.createDataFrame(edges, SCHEMA)
    inside, rounds = both(monkeypatch, lambda: components.strong_components(df))
    assert inside == rounds
    plain = [e for e in edges if None not in e]
    assert dict(inside).items() >= brute.strong(plain, brute.vertices(plain)).items()


def test_strong_components_of_a_long_chain(spark):
    """Deeper than Python's own recursion goes."""
    n = 5_000
    edges = [(v, v + 1) for v in range(n)] + [(n, n - 1)]
    found = dict(map(tuple, components.strong_components(spark.createDataFrame(edges, "src long, dst long")).collect()))
    assert found == {v: min(v, n - 1) for v in range(n + 1)}


@pytest.mark.parametrize("seed", [1, 2])
def test_forest(spark, monkeypatch, seed):
    edges = [*brute.random_graph(seed, n=25, m=60), (3, 4, None), (70, 71, None), (5, None, 1)]
    df = spark.createDataFrame(edges, SCHEMA)
    inside, rounds = both(monkeypatch, lambda: components.spanning_forest(df, "weight"))
    assert inside == rounds and len(inside) > 10


def test_small_graphs_take_few_jobs(spark):
    """A chain of 300: rounds of jobs would be many."""
    df = spark.createDataFrame([(v, v + 1, 1) for v in range(300)], SCHEMA)
    spark.sparkContext.setJobGroup("small", "components")
    components.weak_components(df).collect()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("small"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 15


def test_dense_graphs_are_thinned_out_first(spark, monkeypatch):
    """Components of a graph of many edges, nulls included, from fewer edges than vertices per task."""
    edges = [(a, b, 1) for base in (0, 100) for a in range(base, base + 40) for b in range(base, base + 40) if a != b] + [(7, None, 1), (None, 103, 1), (300, 301, 1)]
    df = spark.createDataFrame(edges, SCHEMA).repartition(3)
    thin = [tuple(r) for r in one_task.stars(df).collect()]
    assert len(thin) < 3 * 85 and {(7, None), (None, 103)} <= set(thin)
    monkeypatch.setattr(skew, "fits_task", lambda rows: rows < 1_000)
    monkeypatch.setattr(one_task, "EDGES_AT_ONCE", 500)
    seen, plain = [], components._smallest_reaching
    monkeypatch.setattr(components, "_smallest_reaching", lambda edges, *args: seen.append(edges.count()) or plain(edges, *args))
    got = {r["id"]: r["component"] for r in components.weak_components(df).collect()}
    assert got == {**{v: 0 for v in range(40)}, **{v: 100 for v in range(100, 140)}, 300: 300, 301: 300, None: 0}
    assert max(seen) < len(edges)
