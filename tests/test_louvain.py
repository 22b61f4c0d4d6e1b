"""Louvain rounds inside a task are those of the distributed ones."""

import brute
import pytest
from pyspark.sql import functions as F

from flowatlas.operators import community


def test_hash_is_that_of_spark(spark):
    texts = ["", "a", "7#0#42-0", "123456#17#42-1", "x" * 31, "y" * 32, "z" * 77, "äöü#1"]
    found = {r[0]: r[1] for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.xxhash64("t")).collect()}
    assert {t: community._xxhash64(t.encode()) for t in texts} == found


@pytest.mark.parametrize("seed", [1, 2])
def test_rounds_inside_a_task_make_the_same_moves(spark, monkeypatch, seed):
    """With null ends and weights and loops; one job makes all rounds of a level."""
    links = {}
    for a, b, w in brute.random_graph(seed, n=40, m=150):
        links[a, b] = links.get((a, b), 0) + w
        links[b, a] = links.get((b, a), 0) + w
    rows = [(a, b, float(w)) for (a, b), w in links.items()] + [(3, None, 2.0), (None, 3, 2.0), (4, 400, None), (400, 4, None), (5, 5, 3.0)]
    df = spark.createDataFrame(rows, "src long, dst long, w double")
    whole = sum(w for *_, w in rows if w)
    found, jobs = [], []
    for most in (community.LINKS_INSIDE, 0):
        monkeypatch.setattr(community, "LINKS_INSIDE", most)
        spark.sparkContext.setJobGroup(f"level-{most}", "a level")
        groups, values = community.local_moves(df, whole, "s", 1e-9)
        found.append(({r["id"]: r["label"] for r in groups.collect()}, [pytest.approx(v) for v in values]))
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"level-{most}")))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found[0][0] == found[1][0] and len(values) > 3
    assert found[0][1] == values
    assert 2 * jobs[0] < jobs[1]
