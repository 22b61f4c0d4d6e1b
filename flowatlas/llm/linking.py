"""Connected components of links between rows, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowatlas.llm.common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _minima(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of each node, as a table: the join behind it then has two shuffled sides, and Spark splits hot ones."""
    return written(edges.groupBy("u").agg(F.min("v").alias("m")))


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` for every id in the links ``(a, b)``; a component is named by its smallest id.

    Alternating stars: every node ties its larger neighbours to the smallest node it knows, then its smaller ones.
    The number of rounds is logarithmic; a round makes no more links than it was given, apart from one per node. No links: no rows.
    """
    edges = written(links.filter(F.col("a") != F.col("b"))
                    .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = written(both.filter("v > u").join(_minima(both), "u")
                        .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        least = _minima(large)
        edges = written(large.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .unionByName(least.withColumnRenamed("m", "v")).distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
