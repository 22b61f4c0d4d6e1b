"""PageRank as a linear chain of joins (no scalar round trip per iteration)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowatlas.operators.adjacency import Adjacency, vertex_ids
from flowatlas.operators.skew import join_unique
from flowatlas.session import settle, store

TOL_CHECK_EVERY = 10
#: Graphs whose scores one row of ``pagerank_lasting`` holds.
STEPS_AT_ONCE = 16


def edge_shares(edges: DataFrame, weighted: bool, keys: tuple[str, ...] = ()) -> DataFrame:
    """Fraction of a source's score that each of its edges carries."""
    on = [*keys, "src"]
    weight = F.col("weight").cast("double") if weighted else F.lit(1.0)
    totals = edges.groupBy(*on).agg(F.sum(weight).alias("_total"))
    return join_unique(edges, totals, on, big_rows=edges.count()).select(*on, "dst", (weight / F.col("_total")).alias("share"))


def _factors(sums: list[float], iterations: int) -> list[float]:
    """Factors a[j] with rank = sum_j a[j] * y_j, from the column sums s_j of y_j (see ``pagerank``)."""
    n = sums[0]
    a = [1.0 / n]
    for _ in range(iterations):
        flowing = sum(c * s for c, s in zip(a, sums[1:]))
        a = [(1.0 - flowing) / n, *a]
    return a


def pagerank(edges: DataFrame, weighted: bool = True, max_iter: int = 20, alpha: float = 0.85,
             tol: float | None = None, scale: str = "one", vertices: DataFrame | None = None,
             keys: tuple[str, ...] = ()) -> DataFrame:
    """Scores ``(keys..., id, pagerank)`` after ``max_iter`` power iterations.

    One iteration is ``r' = alpha * P^T r + c * 1`` where the scalar ``c`` holds the teleport share
    and the dangling mass, fixed by ``sum(r') = 1``. With ``y_0 = 1`` and ``y_{k+1} = alpha * P^T y_k``
    every iterate is a combination of the ``y_k`` whose factors follow from the sums of the ``y_k``
    alone. So the loop is one join and one aggregation per iteration, and the scalars are worked out
    once at the end. With ``tol`` the loop stops at the end of the first block of iterations in which
    the L1 change between two iterates is below ``n * tol``. ``scale="n"`` multiplies by the number
    of vertices. Vertices given without edges get the base score.
    """
    edges = settle(edges.select(*keys, "src", "dst", "weight"))
    if vertices is None:
        vertices = vertex_ids(edges, keys)
    current = settle(vertices.select(*keys, "id", F.lit(1.0).alias("y")))
    links = Adjacency(edge_shares(edges, weighted, keys), current.count(), keys)
    levels = [current]
    scores = None
    while scores is None:
        sent = links.push(current).withColumn("y", F.col("y") * F.col("share") * F.lit(alpha))
        current = settle(sent.groupBy(*keys, F.col("dst").alias("id")).agg(F.sum("y").alias("y")))
        levels.append(current)
        if len(levels) > max_iter:
            scores = _combine(levels, keys, None)
        elif tol is not None and len(levels) % TOL_CHECK_EVERY == 0:
            scores = _combine(levels, keys, tol)
    links.release()
    if scale == "n" and keys:
        sizes = vertices.groupBy(*keys).agg(F.count("*").alias("_n"))
        scores = scores.join(sizes, list(keys)).withColumn("pagerank", F.col("pagerank") * F.col("_n")).drop("_n")
    elif scale == "n":
        scores = scores.withColumn("pagerank", F.col("pagerank") * vertices.agg(F.count("*")).scalar())
    return scores


def pagerank_lasting(edges: DataFrame, vertices: DataFrame, steps: range, weighted: bool = True, max_iter: int = 20, alpha: float = 0.85) -> DataFrame:
    """``(step, id, pagerank)`` of the graphs of ``steps``: a graph has the edges and vertices whose ``death`` is above its step.

    ``pagerank`` of all of them without a copy of the edges for each: a state row has a column per step, ``STEPS_AT_ONCE`` at most, and an edge
    carries those below its death.
    """
    parts = [_lasting(edges, vertices, steps[k:k + STEPS_AT_ONCE], weighted, max_iter, alpha) for k in range(0, len(steps), STEPS_AT_ONCE)]
    return reduce(DataFrame.unionByName, parts)


def _lasting(edges: DataFrame, vertices: DataFrame, steps: range, weighted: bool, max_iter: int, alpha: float) -> DataFrame:
    weight = F.col("weight").cast("double") if weighted else F.lit(1.0)
    edges = settle(edges.filter(F.col("death") > steps[0]).select("src", "dst", "death", weight.alias("w")))
    lives = {s: F.col("death") > s for s in steps}
    totals = store(edges.groupBy("src").agg(*[F.sum(F.when(lives[s], F.col("w"))).alias(f"o{s}") for s in steps]).withColumnRenamed("src", "id"))
    current = store(vertices.select("id", *[F.when(lives[s], F.lit(1.0)).alias(f"y{s}") for s in steps]))
    rows = current.count()
    links = Adjacency(edges, rows * len(steps))
    levels = [current]
    for _ in range(max_iter):
        ready = join_unique(current, totals, ["id"], rows, big_rows=rows).select("id", *[(F.col(f"y{s}") / F.col(f"o{s}") * F.lit(alpha)).alias(f"y{s}") for s in steps])
        sent = links.push(ready)
        current = store(sent.groupBy(F.col("dst").alias("id")).agg(*[F.sum(F.when(lives[s], F.col(f"y{s}") * F.col("w"))).alias(f"y{s}") for s in steps]))
        levels.append(current)
    links.release()
    one = F.explode(F.array(*[F.struct(F.lit(s).alias("step"), F.col(f"y{s}").alias("y")) for s in steps])).alias("x")
    return _combine([y.select("id", one).select("x.step", "id", "x.y").filter("y IS NOT NULL") for y in levels], ("step",), None)


def _combine(levels: list[DataFrame], keys: tuple[str, ...], tol: float | None) -> DataFrame | None:
    spark = levels[0].sparkSession
    stacked = reduce(DataFrame.unionByName, [y.withColumn("k", F.lit(k)) for k, y in enumerate(levels)])
    # One row per (keys, k): number of side-by-side graphs times iterations.
    sums: dict[tuple, list[float]] = {}
    for row in stacked.groupBy(*keys, "k").agg(F.sum("y").alias("s")).collect():
        sums.setdefault(tuple(row[c] for c in keys), [0.0] * len(levels))[row["k"]] = row["s"]
    rows = []
    for key, s in sums.items():
        last = _factors(s, len(levels) - 1)
        before = [*_factors(s, len(levels) - 2), 0.0]
        rows += [(*key, k, a, a - b) for k, (a, b) in enumerate(zip(last, before))]
    types = dict(levels[0].dtypes)
    key_schema = "".join(f"{c} {types[c]}, " for c in keys)
    factors = spark.createDataFrame(rows, f"{key_schema}k int, a double, d double")
    scores = settle(
        stacked.join(F.broadcast(factors), [*keys, "k"])
        .groupBy(*keys, "id")
        .agg(F.sum(F.col("y") * F.col("a")).alias("pagerank"), F.sum(F.col("y") * F.col("d")).alias("change"))
    )
    if tol is not None:
        error = F.sum(F.abs("change")) / F.count("*")
        worst = scores.groupBy(*keys).agg(error.alias("e")).agg(F.max("e")).first()[0]
        if worst >= tol:
            return None
    return scores.drop("change")
