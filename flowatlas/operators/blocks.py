"""Messages from many sources at once, as matrices: vertices in chunks, sources in blocks.

A state is a relation ``(keys..., chunk, block, ...)`` whose binary columns hold a row per vertex of the chunk and a column per source of the
block, compressed. The edges are packed once by (chunk of the source, chunk of the target, part), at most about ``EDGES_PER_UNIT`` in a row; a part has all edges of
its targets, unless a target alone has too many. A push sends the state of a chunk to the packed edges that leave it. A task unpacks the edges of a unit and takes
one of ``STATES_PER_LOT`` states after the other, so edges are not copied per block or graph; what arrives is combined per (chunk, block). So
no task holds more than a chunk's matrices, the compressed states of a lot and one row of packed edges, and a shuffled row stands for ``CELLS`` pairs of a source and a
vertex, not for one. States and shuffles are removed as soon as the next round is written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowatlas.operators.ordering import global_rank
from flowatlas.operators.skew import join_unique
from flowatlas.session import discard, settle

#: Cells of 8 bytes that the matrix of a chunk and block has, about.
CELLS = 2_000_000
EDGES_PER_UNIT = 4_000_000
#: States that one task group meets, compressed.
STATES_PER_LOT = 8
#: Cells that one step inside a task holds beside the matrices.
STEP_CELLS = 1 << 17
#: Partitions of a push, at most.
MAX_WIDTH = 2_000


def packed(matrix: np.ndarray) -> bytes:
    """The array's bytes, compressed, behind their number."""
    raw = np.ascontiguousarray(matrix).tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def unpacked(blob: bytes, dtype) -> np.ndarray:
    size = int.from_bytes(blob[:8], "little")
    return np.frombuffer(pa.Codec("zstd", 1).decompress(memoryview(blob)[8:], size), dtype) if size else np.zeros(0, dtype)


def matrix(blob: bytes, dtype, wide: int) -> np.ndarray:
    """A fresh matrix with ``wide`` columns."""
    return unpacked(blob, dtype).reshape(-1, wide).copy()


def _row_kind(size: int) -> type:
    return np.uint16 if size <= 1 << 16 else np.uint32


def _pack(unit: list[str], edge: list[str], size: int):
    """Edges by target and source, as differences (which wrap around)."""
    kind = _row_kind(size)

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(rows["d"].to_numpy(np.int64) * size + rows["s"].to_numpy(np.int64), kind="stable")
        values = {c: rows[c].to_numpy()[order] for c in edge}
        values |= {c: np.diff(values[c].astype(kind), prepend=kind(0)) for c in ("s", "d")}
        return pd.DataFrame([(*key, *[packed(values[c]) for c in edge])], columns=[*unit, *edge])
    return pack


class Unit:
    """Packed edges: the rows of their sources and targets, the targets ascending; their costs and the ages up to which they last."""

    def __init__(self, edge: pd.Series, size: int, cost: type | None = None):
        self.source, self.target = (np.cumsum(unpacked(edge[c], _row_kind(size)), dtype=_row_kind(size)) for c in ("s", "d"))
        self.cost = None if cost is None else unpacked(edge["cost"], cost)
        self.last = unpacked(edge["last"], np.int16) if "last" in edge else None
        self._back = None

    def alive(self, age: int | None) -> np.ndarray | slice:
        return slice(None) if self.last is None else self.last > age

    def back(self) -> np.ndarray:
        """Order by source."""
        if self._back is None:
            self._back = np.argsort(self.source, kind="stable")
        return self._back


def runs(target: np.ndarray, wide: int) -> tuple[np.ndarray, Iterator[tuple[int, int, int]]]:
    """The different ``target`` (ascending), and the runs ``(place of the target, from, to)`` of at most ``STEP_CELLS`` cells each."""
    starts = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]])) if len(target) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(target))
    step = max(1, STEP_CELLS // wide)
    pieces = ((i, a, min(a + step, hi)) for i, (lo, hi) in enumerate(zip(starts.tolist(), ends.tolist())) for a in range(lo, hi, step))
    return target[starts].astype(np.int32), pieces


class Blocks:
    """Edges ``(keys..., src, dst[, cost])`` laid out for states of ``wide`` columns and all ``vertices`` ``(keys..., id)``.

    Rows with a null end or cost are left out: they carry nothing.

    With ``lasting``, a number in each edge, the edges have no key: they belong to all graphs of ``vertices`` whose only key, a number, is below it. They are
    packed once, not once per graph.
    """

    def __init__(self, edges: DataFrame, vertices: DataFrame, wide: int, keys: tuple[str, ...] = (), lasting: str | None = None):
        if lasting and len(keys) != 1:
            raise ValueError("lasting edges need one key")
        self.keys, self.wide, self.lasting = list(keys), wide, bool(lasting)
        if lasting:
            edges = edges.select("src", "dst", F.col(lasting).cast("short").alias("last"))
        ids = vertices.select("id").distinct().filter(F.col("id").isNotNull())
        place = (F.col("place") - 1).cast("long")
        ranked = settle(global_rank(ids, [F.col("id")], "place").select("id", place.alias("place")))
        self.n = ranked.count()
        self.chunks = max(1, -(-self.n * wide // CELLS))
        self.size = max(1, -(-self.n // self.chunks))
        self.chunks = -(-self.n // self.size)
        self.places = ranked.select("id", "place", F.floor(F.col("place") / self.size).cast("int").alias("chunk"), (F.col("place") % self.size).cast("int").alias("row"))
        self.own = own = [] if lasting else self.keys
        unit, kinds = [*own, "a", "b", "part"], dict(edges.dtypes)
        edge = ["s", "d", *[c for c in ("cost", "last") if c in edges.columns]]
        tips = self.places.select("id", "chunk", "row")
        placed = edges.dropna(subset=[c for c in ("src", "dst", "cost", "last") if c in edges.columns])
        placed = join_unique(placed, tips.toDF("src", "a", "s"), ["src"], self.n)
        placed = join_unique(placed, tips.toDF("dst", "b", "d"), ["dst"], self.n).select(*own, "a", "b", *edge)
        # A row per vertex, chunk it is reached from (and key).
        degrees = settle(placed.groupBy(*own, "a", "b", "d").agg(F.count("*").alias("n")))
        # A row per pair of chunks (and key).
        counts = settle(degrees.groupBy(*own, "a", "b").agg(F.ceil(F.sum("n") / EDGES_PER_UNIT).cast("int").alias("parts")))
        # Two rows per part at most: targets with too many edges for one.
        hot = settle(degrees.filter(2 * F.col("n") > EDGES_PER_UNIT).select(*own, "a", "b", "d", F.lit(True).alias("hot")))
        part = F.pmod(F.when(F.col("hot"), F.xxhash64("s", "d")).otherwise(F.xxhash64("d")), "parts").cast("int").alias("part")
        self.counts = counts
        packs = counts.agg(F.coalesce(F.sum("parts"), F.lit(0))).first()[0]
        self.single = self.chunks <= 1 and packs == counts.count()
        schema = f"{''.join(f'{c} {kinds[c]}, ' for c in own)}a int, b int, part int, {', '.join(f'{c} binary' for c in edge)}"
        # Whole parts go to a task each, about, and are sorted there; an aggregation would hold all edges of a task as objects.
        self.edges = settle(
            placed.join(F.broadcast(counts), [*own, "a", "b"]).join(F.broadcast(hot), [*own, "a", "b", "d"], "left").select(*own, "a", "b", part, *edge)
            .repartition(max(1, min(2 * packs, MAX_WIDTH)), *unit).groupBy(*unit).applyInPandas(_pack(unit, edge, self.size), schema))
        for done in (degrees, hot):
            discard(done)
        self.where = settle(self.edges.select(*unit))
        self.units = packs
        self.graphs = vertices.select(*self.keys).distinct().dropna().count() if lasting else 1
        self.on, self.laid = [*own, "a", "b", "part", "lot"], None

    def lay(self, blocks: int) -> None:
        """Lays the packed edges out for all rounds, for states of at most ``blocks`` blocks at once: a copy for every lot of states."""
        self.release()
        spark = self.edges.sparkSession
        self.states = blocks * self.graphs * (1 if self.lasting else max(1, self.counts.count()))
        self.tasks = 4 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        states = blocks * self.graphs
        self.lots = max(-(-states // STATES_PER_LOT), min(states, -(-self.tasks // max(1, 2 * self.units))))
        self.width = max(1, min(2 * self.units * self.lots, MAX_WIDTH))
        lots = F.explode(F.sequence(F.lit(0), F.lit(self.lots - 1))).alias("lot")
        self.laid = self.edges.select("*", lots).repartition(self.width, *self.on).persist(StorageLevel.MEMORY_AND_DISK)

    def push(self, state: DataFrame, kernel: Callable, schema: str, there: DataFrame | None = None, back: bool = False, cost: type | None = None) -> DataFrame:
        """What ``kernel(unit, age, own, there)`` finds for every state a unit's chunk has (``own``, and ``there`` of its target chunk): rows of a chunk and what they are sent.

        ``back`` follows the edges from target to source. ``schema`` is that of the result ``(keys..., chunk, block, origin, rows, moved)``; ``rows`` and ``moved`` are packed.
        """
        at, to = ("b", "a") if back else ("a", "b")
        where = F.broadcast(self.where)
        met = state.withColumnRenamed("chunk", at).join(where, [*self.own, at]).withColumn("side", F.lit(0))
        if there is not None:
            met = met.unionByName(there.withColumnRenamed("chunk", to).join(where, [*self.own, to]).withColumn("side", F.lit(1)), allowMissingColumns=True)
        number = F.col("block") * self.graphs + F.col(self.keys[0]) if self.lasting else F.col("block")
        # New columns: both sides come from the packed edges.
        met = met.withColumn("lot", F.pmod(number, F.lit(self.lots)).cast("int"))
        met = met.toDF(*met.columns).repartition(self.width, *self.on)
        run = _each(kernel, self.keys, self.size, self.lasting, back, there is not None, cost)
        return self.laid.groupBy(*self.on).cogroup(met.groupBy(*self.on)).applyInPandas(run, schema)

    def combine(self, known: DataFrame, sent: DataFrame, kernel: Callable) -> DataFrame:
        """``kernel(key, rows)`` of a state row and what was sent to it, sent rows last and in the order of ``origin``. ``known`` is gone afterwards."""
        on = [*self.keys, "chunk", "block"]
        width = max(1, min(self.chunks * self.states, self.tasks, MAX_WIDTH))
        both = known.withColumn("origin", F.lit("")).unionByName(sent, allowMissingColumns=True).repartition(width, *on)
        out = settle(both.groupBy(*on).applyInPandas(lambda key, rows: kernel(key, rows.sort_values("origin")), known.schema))
        discard(known)
        return out

    def release(self) -> None:
        if self.laid is not None:
            self.laid.unpersist()
            self.laid = None

    def drop(self) -> None:
        """Removes the packed edges."""
        self.release()
        for done in (self.edges, self.where, self.counts):
            discard(done)


def _each(kernel: Callable, keys: list[str], size: int, lasting: bool, back: bool, both: bool, cost: type | None):
    columns = [*keys, "chunk", "block", "origin", "rows", "moved"]

    def run(key: tuple, edges: pd.DataFrame, met: pd.DataFrame) -> pd.DataFrame:
        if not len(edges) or not len(met):
            return empty(columns)
        unit, found = Unit(edges.iloc[0], size, cost), []
        origin = "/".join(f"{int(k):012d}" for k in key[-4:-1])
        for state, rows in met.groupby([*keys, "block"]):
            own, there = rows[rows["side"] == 0], rows[rows["side"] == 1]
            if not len(own) or both and not len(there):
                continue
            at, moved = kernel(unit, state[0] if lasting else None, own.iloc[0], there.iloc[0] if both else None)
            if len(at):
                found.append((*state[:-1], int(key[-4 if back else -3]), int(state[-1]), origin, packed(at.astype(np.int32)), packed(moved)))
        return pd.DataFrame(found, columns=columns) if found else empty(columns)
    return run


def empty(columns: list[str]) -> pd.DataFrame:
    return pd.DataFrame({c: [] for c in columns}, dtype=object)
