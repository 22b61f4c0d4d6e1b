"""Approximate nearest neighbours with a hash-prefix forest.

A tree gives every vector a hash string of ``BITS`` signs of random projections; its index is the array of all strings in order. A query
descends to the rows that share the longest prefix with it, of whatever length. Then all trees ascend together: one bit less
of the prefix in every step, which adds the rows that share that prefix and no longer one. Two vectors with cosine s share a bit with probability
``p = 1 - acos(s) / pi``, so a row that is nearer than the k-th one found stays unseen at prefix length x with probability ``(1 - p ** x) ** TREES`` at most. The ascent ends
when that falls to ``MISS``: queries with near neighbours stop at long prefixes, others go on, and the expected recall is
``1 - MISS`` at least, whatever the data. Candidates are compared by cosine in double precision; none is left out.

The rows are dealt by a hash of their id over shards of about ``SHARD`` rows, so a group of near copies spreads over all of them. A shard is one row of the
index table: vectors, ids, and per tree the sorted strings and the order. Queries travel to the shards in blocks of at most ``QUERIES`` (a
broadcast of bounded size), in two passes over the index: the descent, whose results together give each query a first k-th cosine; and the ascent, which
starts from it, so shards without near rows stop at once. Each pass returns k rows per query and shard.

Vectors that are null, empty or zero or hold null or non-finite components take no part, nor do rows without an id. Of rows that repeat an id the one with the smallest
vector (in the order of its bytes) counts. Vectors of different length are not compared. With fewer candidates than k a query
gets them all; with none, or an empty table, no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowatlas.llm.common import map_arrow, read_table, written

TREES, BITS, MISS, K, EVERY = 32, 64, 0.05, 5, 50
#: Rows of a shard, queries of a block, about; queries followed together and rows hashed at once.
SHARD, QUERIES, TOGETHER, HASHED = 16_384, 16_384, 512, 2_048
SEED = 20240613


def planes(dimensions: int, trees: int = TREES) -> np.ndarray:
    """The random directions of all trees, (dimensions, trees * BITS)."""
    return np.random.Generator(np.random.PCG64([SEED, dimensions])).standard_normal((dimensions, trees * BITS)).astype(np.float32)


def hash_strings(x: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """(rows, trees) strings as unsigned integers, the first bit the highest."""
    out = np.empty((len(x), directions.shape[1] // BITS), np.uint64)
    for s in range(0, len(x), HASHED):
        signs = x[s:s + HASHED].astype(np.float32) @ directions > 0
        out[s:s + HASHED] = np.packbits(signs, axis=1).view(">u8")
    return out


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _prefix_length(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading bits in common."""
    differ = a ^ b
    high = (differ >> np.uint64(32)).astype(np.uint32)
    word = np.where(high > 0, high, differ.astype(np.uint32))
    zeros = 32 - np.frexp(word.astype(np.float64))[1]
    return np.where(high > 0, zeros, 32 + zeros)


class Forest:
    """Sorted strings of some vectors: ``strings[t]`` in order, ``order[t]`` the rows they belong to."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, strings: np.ndarray, order: np.ndarray):
        self.ids, self.x, self.strings, self.order = ids, x, strings, order

    @classmethod
    def build(cls, ids: np.ndarray, x: np.ndarray) -> Forest:
        strings = hash_strings(x, planes(x.shape[1])).T
        order = np.argsort(strings, axis=1, kind="stable")
        return cls(ids, x, np.take_along_axis(strings, order, axis=1), order.astype(np.int32))

    def descend(self, strings: np.ndarray) -> np.ndarray:
        """Longest prefix that each query (queries, trees) shares with any row, by binary search."""
        n = self.strings.shape[1]
        out = np.zeros(strings.shape, np.int64)
        for t in range(strings.shape[1]):
            at = np.searchsorted(self.strings[t], strings[:, t])
            for side in (np.maximum(at - 1, 0), np.minimum(at, n - 1)):
                out[:, t] = np.maximum(out[:, t], _prefix_length(strings[:, t], self.strings[t][side]))
        return out

    def ranges(self, strings: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Bounds (trees, queries) of the rows that share the first ``length`` bits."""
        mask = np.uint64(0) if length == 0 else np.uint64(((1 << length) - 1) << (BITS - length))
        low, high = np.empty((strings.shape[1], len(strings)), np.int64), np.empty((strings.shape[1], len(strings)), np.int64)
        for t in range(strings.shape[1]):
            low[t] = np.searchsorted(self.strings[t], strings[:, t] & mask)
            high[t] = np.searchsorted(self.strings[t], strings[:, t] | ~mask, "right")
        return low, high

    def best(self, q: np.ndarray, own: int, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, cosines) of the k nearest among ``rows``, ties to the smaller id."""
        rows = rows[self.ids[rows] != own]
        about = self.x[rows] @ q
        if len(rows) > k:
            rows = rows[about >= np.partition(about, -k)[-k] - 1e-9]
        # Sums of products in one order for every row: equal vectors have equal cosines.
        score = (self.x[rows] * q).sum(axis=1)
        first = np.lexsort([self.ids[rows], -score])[:k]
        return rows[first], score[first]


def stop_length(score: float, trees: int = TREES, miss: float = MISS) -> int:
    """Prefix length from which on a row with this cosine is missed by all trees with probability ``miss`` at most."""
    p = 1 - np.arccos(min(max(score, -1.0), 1.0)) / np.pi
    needed = 1 - miss ** (1 / trees)
    if p >= 1:
        return BITS
    return 0 if p <= 0 else min(BITS, int(np.log(needed) / np.log(p)))


def descent(forest: Forest, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, cosine) of the k nearest among each query's longest-prefix matches of all trees."""
    strings = hash_strings(x, planes(x.shape[1]))
    longest = forest.descend(strings)
    low, high = (np.empty((strings.shape[1], len(x)), np.int64) for _ in range(2))
    for length in np.unique(longest).tolist():
        a, b = forest.ranges(strings, length)
        here = (longest == length).T
        low[here], high[here] = a[here], b[here]
    return _collect(len(x), lambda i: _candidates(forest, low[:, i], high[:, i]), forest, ids, x, k)


def _candidates(forest: Forest, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    seen = np.zeros(len(forest.ids), bool)
    for t in range(len(low)):
        seen[forest.order[t, low[t]:high[t]]] = True
    return np.flatnonzero(seen)


def _collect(n: int, candidates, forest: Forest, ids: np.ndarray, x: np.ndarray, k: int):
    found = [forest.best(x[i], ids[i], candidates(i), k) for i in range(n)]
    sizes = [len(rows) for rows, _ in found]
    empty = [(np.zeros(0, np.int64), np.zeros(0))]
    rows, scores = (np.concatenate(part) for part in zip(*(found or empty)))
    return np.repeat(np.arange(n), sizes), rows, scores


def ascent(forest: Forest, ids: np.ndarray, x: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, cosine) of the k nearest found while all trees ascend together; ``bound`` holds the k-th cosine known for each query."""
    strings = hash_strings(x, planes(x.shape[1]))
    longest = forest.descend(strings)
    top = longest.max(axis=1, initial=0)
    bound = bound.copy()
    stop = np.array([stop_length(s) if np.isfinite(s) else 0 for s in bound], np.int64)
    seen: dict[int, np.ndarray] = {}
    kept: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0))] * len(x)
    before: tuple[np.ndarray, np.ndarray] | None = None
    active = np.flatnonzero(top >= stop)
    for length in range(int(top.max(initial=0)), -1, -1):
        active = active[stop[active] <= length]
        if not len(active):
            break
        going = active[top[active] >= length]
        if not len(going):
            continue
        low, high = (np.zeros((strings.shape[1], len(x)), np.int64) for _ in range(2))
        low[:, going], high[:, going] = forest.ranges(strings[going], length)
        for i in going.tolist():
            mark = seen.get(i)
            if mark is None:
                mark = seen[i] = np.zeros(len(forest.ids), bool)
                fresh = _candidates(forest, low[:, i], high[:, i])
            else:
                # Only what this step adds on both sides of the longer prefix.
                parts = []
                for t in range(strings.shape[1]):
                    parts += [forest.order[t, low[t, i]:before[0][t, i]], forest.order[t, before[1][t, i]:high[t, i]]]
                fresh = np.unique(np.concatenate(parts))
                fresh = fresh[~mark[fresh]]
            if len(fresh):
                mark[fresh] = True
                kept[i] = forest.best(x[i], ids[i], np.concatenate([kept[i][0], fresh]), k)
                if len(kept[i][0]) == k and kept[i][1][-1] > bound[i]:
                    bound[i] = kept[i][1][-1]
                    stop[i] = stop_length(bound[i])
            if stop[i] >= length:
                seen.pop(i)
        before = (low, high)
    sizes = [len(rows) for rows, _ in kept]
    if not kept:
        kept = [(np.zeros(0, np.int64), np.zeros(0))]
    rows, scores = (np.concatenate(part) for part in zip(*kept))
    return np.repeat(np.arange(len(x)), sizes), rows, scores


def _ready(batches):
    """``(vec_id, d, vector)``: usable vectors as the bytes of doubles."""
    for batch in batches:
        ids, sizes, raw = [], [], []
        for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
            if i is None or v.as_py() is None or v.values.null_count:
                continue
            x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if len(x) and np.isfinite(x).all() and x.any():
                ids.append(i)
                sizes.append(len(x))
                raw.append((x + 0.0).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int32()), pa.array(raw, pa.binary())], names=["vec_id", "d", "vector"])


def vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows that take part, one per id, as a table."""
    ready = map_arrow(rows.select(F.col("vec_id").cast("long"), vector), _ready, "vec_id long, d int, vector binary")
    return written(ready.groupBy("vec_id").agg(F.min(F.struct("vector", "d")).alias("x")).select("vec_id", "x.d", "x.vector"))


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("vec_id")
    d = int(pdf["d"].iloc[0])
    x = np.frombuffer(b"".join(pdf["vector"]), np.float64).reshape(len(pdf), d)
    ids = pdf["vec_id"].to_numpy(np.int64)
    forest = Forest.build(ids, unit(x))
    return pd.DataFrame({"d": [d], "ids": [ids.tobytes()], "vectors": [x.tobytes()],
                         "strings": [forest.strings.tobytes()], "places": [forest.order.tobytes()]})


def build_index(rows: DataFrame) -> DataFrame:
    """The forest as a table with a row per shard, from the rows ``(vec_id, d, vector)``."""
    shards = max(1, -(-rows.count() // SHARD))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    return written(dealt.groupBy("d", "shard").applyInPandas(_pack, "d int, ids binary, vectors binary, strings binary, places binary"), "index")


def _load(row: dict) -> Forest:
    ids = np.frombuffer(row["ids"], np.int64)
    x = unit(np.frombuffer(row["vectors"], np.float64).reshape(len(ids), -1))
    return Forest(ids, x, np.frombuffer(row["strings"], np.uint64).reshape(-1, len(ids)), np.frombuffer(row["places"], np.int32).reshape(-1, len(ids)))


def _pass(index: DataFrame, queries: list, k: int, ascending: bool) -> DataFrame:
    """``(query_id, vec_id, score)``: k rows per query and shard. ``queries``: rows (vec_id, d, vector, bound)."""
    packed: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for d in sorted({q["d"] for q in queries}):
        some = sorted((q["vec_id"], bytes(q["vector"]), q["bound"]) for q in queries if q["d"] == d)
        packed[d] = (np.array([q[0] for q in some], np.int64), np.frombuffer(b"".join(q[1] for q in some), np.float64).reshape(-1, d).copy(),
                     np.array([-np.inf if q[2] is None else q[2] for q in some]))
    shared = index.sparkSession.sparkContext.broadcast(packed)

    def run(batches):
        for batch in batches:
            for k_row in range(len(batch)):
                row = {n: batch.column(j)[k_row].as_py() for j, n in enumerate(batch.schema.names)}
                if row["d"] not in shared.value:
                    continue
                ids, x, bound = shared.value[row["d"]]
                forest, x = _load(row), unit(x)
                for s in range(0, len(x), TOGETHER):
                    part = slice(s, s + TOGETHER)
                    at, found, scores = ascent(forest, ids[part], x[part], bound[part], k) if ascending else descent(forest, ids[part], x[part], k)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[part][at]), pa.array(forest.ids[found]), pa.array(scores)], names=["query_id", "vec_id", "score"])

    return written(map_arrow(index, run, "query_id long, vec_id long, score double"))


def _first(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k)


def search(index: DataFrame, queries: DataFrame, k: int = K, block: int = QUERIES) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest rows of the index found for each query ``(vec_id, d, vector)``, its own id left out."""
    queries = written(queries.select("vec_id", "d", "vector"))
    blocks = max(1, -(-queries.count() // block))
    results = []
    for b in range(blocks):
        some = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b)
        start = _pass(index, some.withColumn("bound", F.lit(None).cast("double")).collect(), k, ascending=False)
        known = _first(start, k).filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("bound"))
        again = _pass(index, some.join(known, "vec_id", "left").collect(), k, ascending=True)
        results.append(start.unionByName(again).distinct())
    return _first(reduce(DataFrame.unionByName, results), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op13_neighbours(spark, sf_dir: str) -> DataFrame:
    """Nearest vectors of every vector whose id is divisible by 50."""
    rows = vectors(read_table(spark, sf_dir, "embeddings"))
    return search(build_index(rows), rows.filter(F.col("vec_id") % EVERY == 0))
