"""Message passing along edges, the step shared by all iterative graph operators.

A graph is a relation ``(src, dst, ...)``, optionally with leading key columns (for example
``step``) when several graphs are processed side by side. ``Adjacency`` lays the edges out once and
picks, from counted sizes, how state rows meet them:

* state of at most ``BROADCAST_ROWS`` rows: the state is broadcast and the edges stay where they are;
* else edges of at most ``BROADCAST_ROWS`` rows: the edges are broadcast and the state stays;
  both only where the side is small or the other much larger (``skew.worth_broadcasting``), since every push sends it through the driver;
* else the edges are kept hash partitioned by ``(src, part)`` and a push moves only the state. ``part``
  splits the edges of one source into pieces of about ``ROWS_PER_PART``; a source holding a third of
  all edges becomes many keys, and its state row is copied to each of them.

Messages are always combined by a hash aggregation on the target, which Spark combines before the
shuffle, so a hot target does not become a hot task.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowatlas.operators import skew
from flowatlas.session import settle

EDGES_PER_TASK = 20_000


class Adjacency:
    """``state_rows`` is an upper bound on the rows of any state that will be pushed."""

    def __init__(self, edges: DataFrame, state_rows: int, keys: tuple[str, ...] = ()):
        self.keys = list(keys)
        self.on = [*self.keys, "src"]
        self.edges = settle(edges)
        self.count = self.edges.count()
        self.hot = None
        if state_rows <= self.count and skew.worth_broadcasting(state_rows, self.count):
            self.mode = "state"
            self.edges = self.edges.persist(StorageLevel.MEMORY_AND_DISK)
        elif skew.worth_broadcasting(self.count, state_rows):
            self.mode = "edges"
        else:
            self.mode = "shuffle"
            self._spread()

    def _spread(self) -> None:
        degree = self.edges.groupBy(*self.on).agg(F.count("*").alias("_degree"))
        # At most count / ROWS_PER_PART rows; Spark broadcasts or splits the join by measured size.
        self.hot = settle(
            degree.filter(F.col("_degree") > skew.ROWS_PER_PART)
            .select(*self.on, F.ceil(F.col("_degree") / skew.ROWS_PER_PART).cast("int").alias("_parts"))
        )
        part = F.pmod(F.xxhash64("dst"), F.coalesce("_parts", F.lit(1))).cast("int")
        # Few edges in few tasks: a push costs a task per part of the table.
        width = min(int(self.edges.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8 + self.count // EDGES_PER_TASK)
        self.edges = (
            self.edges.join(self.hot, self.on, "left").withColumn("_part", part).drop("_parts")
            .repartition(width, *self.on, "_part")
            .persist(StorageLevel.MEMORY_AND_DISK)
        )

    def push(self, state: DataFrame, at: str = "id") -> DataFrame:
        """Each state row meets all edges leaving ``state[at]``; ``at`` is renamed to ``src``."""
        state = state.withColumnRenamed(at, "src")
        if self.mode == "state":
            return self.edges.join(F.broadcast(state), self.on)
        if self.mode == "edges":
            return state.join(F.broadcast(self.edges), self.on)
        state = (
            state.join(self.hot, self.on, "left")
            .withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
            .drop("_parts")
        )
        # Neither side is sorted, and Spark does not broadcast what was found too large for it.
        return state.hint("shuffle_hash").join(self.edges, [*self.on, "_part"]).drop("_part")

    def release(self) -> None:
        if self.mode != "edges":
            self.edges.unpersist()


def vertex_ids(edges: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Distinct end points (keys..., id); one scan of the edges."""
    return edges.select(*keys, F.explode(F.array("src", "dst")).alias("id")).distinct()


def both_ways(edges: DataFrame, *extra: str) -> DataFrame:
    """Every edge in both directions; reciprocal pairs stay two edges each way."""
    ends = F.explode(F.array(
        F.struct(F.col("src").alias("src"), F.col("dst").alias("dst")),
        F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")),
    )).alias("_pair")
    return edges.select(ends, *extra).select("_pair.src", "_pair.dst", *extra)


def with_loops(edges: DataFrame, vertices: DataFrame, loop_value: dict[str, Column]) -> DataFrame:
    """Edges plus one marked loop per vertex, so that a push also carries a vertex's own state."""
    loops = vertices.select(
        *[c for c in vertices.columns if c != "id"],
        F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(True).alias("loop"),
        *[v.alias(k) for k, v in loop_value.items()],
    )
    return edges.withColumn("loop", F.lit(False)).unionByName(loops)
