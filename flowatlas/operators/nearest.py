"""Exact nearest vectors of all vertices by cosine, without an n x n table.

On unit vectors the cosine falls with the Euclidean distance, so the triangle inequality holds. A few vectors far from each other
are pivots; every vector belongs to the cell of its nearest pivot, and the table is written in the order of cells and
distances. Queries are taken in blocks of neighbouring cells of bounded size, one pass over the table each:

* the distances of a query to the pivots, with the smallest radii of every cell, bound the distance of its k-th neighbour;
* cells that lie beyond that bound for all queries of the block are not read;
* a task goes through its rows in slices; the least and the largest distance of a slice to every pivot give an upper bound for
  the cosine to each query, and queries that cannot gain are left out of the matrix product.

A task holds a block of queries, a slice of rows and ``k`` rows per query, and hands on ``k`` rows per query at most. Cells of any
size are spread over tasks by range, and over blocks by hash. Vectors without structure prune little: then all pairs are compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowatlas.functions.vector import unit
from flowatlas.session import scratch_path, settle

#: Pivots, and the vectors they are chosen from: they change the amount of work only.
PIVOTS, PIVOT_SAMPLE = 32, 2_000
#: Components of all queries of a block; rows of a slice; products held at once.
BLOCK_VALUES, SLICE, PRODUCTS = 2**20, 1_024, 2**22
#: Cosines closer than this are never told apart by a bound.
SLACK = 1e-6

SCHEMA = "anchor long, id long, similarity double, place int"


def _matrix(batch) -> np.ndarray:
    values = batch.column("vector")
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (rows @ pivots.T), 0.0))


def _choose_pivots(sample: np.ndarray) -> np.ndarray:
    """One after the other the vector farthest from those chosen before."""
    chosen = [0]
    nearest = _distances(sample, sample[:1])[:, 0]
    while len(chosen) < min(PIVOTS, len(sample)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def _place(pivots: np.ndarray):
    def run(batches):
        for batch in batches:
            if len(batch):
                distances = _distances(_matrix(batch), pivots)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(distances.argmin(axis=1).astype(np.int32)), pa.array(distances.min(axis=1))],
                    names=[*batch.schema.names, "cell", "radius"])

    return run


class Best:
    """The ``k`` best rows per query seen so far: cosines equal in single precision are ties, the smaller id goes first."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.similarity = np.full((n, k), -np.inf)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)

    def add(self, at: np.ndarray, similarity: np.ndarray, ids: np.ndarray) -> None:
        """Rows ``ids`` with their cosines to the queries ``at``."""
        values = np.concatenate([self.similarity[at], similarity], axis=1)
        names = np.concatenate([self.ids[at], np.broadcast_to(ids, similarity.shape)], axis=1)
        key = values.astype(np.float32)
        least = np.partition(key, -self.k, axis=1)[:, -self.k]
        row, column = np.nonzero(key >= least[:, None])
        order = np.lexsort((names[row, column], -key[row, column], row))
        row, column = row[order], column[order]
        # Every query has k entries at least, the first k of them stay.
        first = np.searchsorted(row, np.arange(len(at)))
        take = (first[:, None] + np.arange(self.k)).ravel()
        self.similarity[at] = values[row[take], column[take]].reshape(-1, self.k)
        self.ids[at] = names[row[take], column[take]].reshape(-1, self.k)


def _search(shared, pivots: np.ndarray, k: int):
    def run(batches):
        ids, queries, bound = shared.value
        to_pivots = _distances(queries, pivots)
        best = Best(len(ids), k)
        for batch in batches:
            for a in range(0, len(batch), SLICE):
                part = batch.slice(a, SLICE)
                rows, names = _matrix(part), part.column("id").to_numpy(zero_copy_only=False)
                distances = _distances(rows, pivots)
                gap = np.maximum(distances.min(axis=0) - to_pivots, to_pivots - distances.max(axis=0)).max(axis=1)
                reach = 1.0 - np.maximum(gap, 0.0) ** 2 / 2
                active = np.flatnonzero(reach >= np.maximum(bound, best.similarity[:, -1]) - SLACK)
                width = max(1, PRODUCTS // len(rows))
                for b in range(0, len(active), width):
                    at = active[b:b + width]
                    similarity = queries[at] @ rows.T
                    similarity[ids[at][:, None] == names[None, :]] = -np.inf
                    best.add(at, similarity, names)
        query, place = np.nonzero(best.similarity >= (bound - SLACK)[:, None])
        seen = np.isfinite(best.similarity[query, place])
        query, place = query[seen], place[seen]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[query]), pa.array(best.ids[query, place]), pa.array(best.similarity[query, place])], names=["anchor", "id", "similarity"])

    return run


def _blocks(sizes: dict[int, int], rows: int) -> list[tuple[list[int], int, int]]:
    """Cells by block, with the part of them and the number of parts: large cells are split, small ones put together."""
    out, open_cells, held = [], [], 0
    for cell, n in sorted(sizes.items()):
        if n > rows:
            parts = -(-n // rows)
            out += [([cell], part, parts) for part in range(parts)]
            continue
        if held + n > rows:
            out.append((open_cells, 0, 1))
            open_cells, held = [], 0
        open_cells, held = [*open_cells, cell], held + n
    return [*out, (open_cells, 0, 1)] if open_cells else out


def nearest_vectors(vectors: DataFrame, k: int = 5) -> DataFrame:
    """``(anchor, id, similarity, place)``: the ``k`` nearest other vectors of every vector ``(id, vector)``, ids of an integer type.

    Vectors that are null, zero or hold null or non-finite components take no part; all others must have one length.
    Where fewer than ``k`` others exist, all are returned. The result is a written table.
    """
    spark = vectors.sparkSession
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    ready = vectors.select(F.col("id").cast("long").alias("id"), unit(F.col("vector").cast("array<double>")).alias("vector")) \
        .filter(F.col("vector").isNotNull() & whole)
    lengths = ready.agg(F.min(F.size("vector")).alias("a"), F.max(F.size("vector")).alias("b")).first()
    if lengths["a"] is None:
        return spark.createDataFrame([], SCHEMA)
    if lengths["a"] != lengths["b"]:
        raise ValueError(f"vectors of {lengths['a']} and of {lengths['b']} components")
    sample = ready.orderBy(F.xxhash64("id"), "id").limit(PIVOT_SAMPLE).select("vector").toArrow()
    pivots = _choose_pivots(_matrix(sample))

    folder = scratch_path(spark, "nearest")
    placed_path, out_path = f"{folder}/placed.parquet", f"{folder}/neighbours.parquet"
    ready.mapInArrow(_place(pivots), "id long, vector array<double>, cell int, radius double") \
        .repartitionByRange("cell", "radius", "id").sortWithinPartitions("cell", "radius").write.parquet(placed_path)
    placed = spark.read.parquet(placed_path)

    # One row per pivot; k + 1 radii per pivot, cut in every task before the shuffle.
    cells = {r["cell"]: r for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("radius").alias("far")).collect()}
    place = F.row_number().over(Window.partitionBy("cell").orderBy("radius"))
    radii = np.full((len(pivots), k + 1), np.inf)
    for r in placed.select("cell", "radius", place.alias("place")).filter(F.col("place") <= k + 1).collect():
        radii[r["cell"], r["place"] - 1] = r["radius"]
    far = np.array([cells[c]["far"] if c in cells else -np.inf for c in range(len(pivots))])

    order = Window.partitionBy("anchor").orderBy(F.col("similarity").cast("float").desc(), "id")
    for mine, part, parts in _blocks({c: r["n"] for c, r in cells.items()}, max(1, BLOCK_VALUES // lengths["a"])):
        asked = placed.filter(F.col("cell").isin(mine) & (F.pmod(F.xxhash64("id"), F.lit(parts)) == part)).select("id", "vector").toArrow()
        if not len(asked):
            continue
        queries, ids = _matrix(asked), asked.column("id").to_numpy()
        to_pivots = _distances(queries, pivots)
        # k + 1 vectors, one of them perhaps the query itself, lie within this distance.
        within = np.concatenate([
            np.partition((to_pivots[a:a + SLICE, :, None] + radii).reshape(-1, radii.size), k, axis=1)[:, k] for a in range(0, len(ids), SLICE)])
        bound = np.where(within < 2.0, 1.0 - np.minimum(within, 2.0) ** 2 / 2, -1.0)
        reach = 1.0 - np.maximum(to_pivots - far, 0.0) ** 2 / 2
        near = np.flatnonzero((reach >= bound[:, None] - SLACK).any(axis=0) & np.isfinite(far)).tolist()
        shared = spark.sparkContext.broadcast((ids, queries, bound))
        found = placed.filter(F.col("cell").isin(near)).select("id", "vector").mapInArrow(_search(shared, pivots, k), "anchor long, id long, similarity double")
        found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).write.mode("append").parquet(out_path)
        shared.destroy()
    return spark.read.schema(SCHEMA).parquet(out_path)
