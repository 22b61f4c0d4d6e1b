"""What happens to the network when its most critical zones are removed one after another.

Every removed zone has a step; an edge dies at the smaller step of its two ends. All steps are then
answered from one relation instead of one filtered graph per step.

Components need no copies of the graph: in a maximum spanning forest by the step at which an edge dies, the edges that die
after a step connect the same vertices as all edges that are left then. So one forest, found once, counts the components of all steps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowatlas.functions.scalar import share_pct
from flowatlas.operators.adjacency import vertex_ids
from flowatlas.operators.components import spanning_forest
from flowatlas.operators.graph import by_score, top_by
from flowatlas.operators.paths import average_path_length
from flowatlas.operators.rank import pagerank_lasting
from flowatlas.session import settle, widened

STEP = ("step",)
#: Removed zones travel to all tasks and every step is a copy of the graph.
MAX_REMOVED = 1_000


class Removal:
    """Cumulative removal of the ``k`` highest scores ``(id, pagerank)``."""

    def __init__(self, edges: DataFrame, scores: DataFrame, k: int = 5):
        if not 0 < k <= MAX_REMOVED:
            raise ValueError(f"between 1 and {MAX_REMOVED} removals")
        self.k = k
        # k rows: small by construction, so it is broadcast.
        self.removed = settle(top_by(scores, "pagerank", k, "step").select("step", "id"))
        vertices = vertex_ids(edges).join(F.broadcast(self.removed), "id", "left")
        self.vertices = settle(vertices.select("id", F.coalesce("step", F.lit(k + 1)).alias("death")))
        source = F.broadcast(self.removed.select(F.col("id").alias("src"), F.col("step").alias("s1")))
        target = F.broadcast(self.removed.select(F.col("id").alias("dst"), F.col("step").alias("s2")))
        death = F.least(F.coalesce("s1", F.lit(k + 1)), F.coalesce("s2", F.lit(k + 1)))
        self.edges = settle(
            edges.join(source, "src", "left").join(target, "dst", "left").select("src", "dst", "weight", death.alias("death"))
        )

        self._forest: DataFrame | None = None

    def forest(self) -> DataFrame:
        """``(src, dst, death)``: fewer edges than vertices, whose living part connects what the living edges connect."""
        if self._forest is None:
            with widened(self.edges.sparkSession, self.edges.count()):
                self._forest = settle(spanning_forest(self.edges, "death"))
        return self._forest

    def _alive(self, relation: DataFrame, first: int) -> DataFrame:
        """A copy per step the row survives: at most k + 1 copies."""
        last = F.col("death") - 1
        return relation.filter(last >= first).withColumn("step", F.explode(F.sequence(F.lit(first), last))).drop("death")

    def flow(self) -> DataFrame:
        """Steps 0..k: remaining flow, edges and vertices; edges are read once, not once per step."""
        lost = self.edges.groupBy(F.col("death").alias("step")).agg(
            F.sum("weight").alias("w"), F.count("*").alias("c")
        )
        # From here on there are k + 2 rows at most.
        start = self.removed.sparkSession.range(1).select(F.lit(0).alias("step"), F.lit(None).cast(dict(self.removed.dtypes)["id"]).alias("id"))
        steps = start.unionByName(self.removed)
        so_far = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
        totals = self.edges.agg(F.sum("weight").alias("w"), F.count("*").alias("c"))
        flow, count = totals.select("w").scalar(), totals.select("c").scalar()
        kept = steps.join(lost, "step", "left").select(
            "step", F.col("id").alias("removed_id"),
            (flow - F.sum(F.coalesce("w", F.lit(0))).over(so_far)).cast("long").alias("remaining_flow"),
            (count - F.sum(F.coalesce("c", F.lit(0))).over(so_far)).alias("remaining_edges"),
        )
        n = self.vertices.agg(F.count("*")).scalar()
        return kept.select(
            "*",
            share_pct(F.col("remaining_flow"), flow).alias("remaining_flow_pct"),
            share_pct(F.col("remaining_edges"), count).alias("remaining_edge_pct"),
            (n - F.col("step")).alias("nodes_remaining"),
        )

    def components(self) -> DataFrame:
        """Weak components left at every step; vertices that lost all edges count as their own."""
        # Per step of death: k + 2 rows at most from here on.
        lives = self.vertices.select("death", F.lit(1).alias("v"), F.lit(0).alias("f")).unionByName(
            self.forest().select("death", F.lit(0).alias("v"), F.lit(1).alias("f"))).groupBy(F.col("death").alias("step")).agg(F.sum("v").alias("v"), F.sum("f").alias("f"))
        steps = self.removed.sparkSession.range(self.k + 2).select(F.col("id").cast("int").alias("step"))
        later = Window.orderBy("step").rowsBetween(1, Window.unboundedFollowing)
        left = steps.join(lives, "step", "left").select(
            "step", F.sum(F.coalesce("v", F.lit(0))).over(later).alias("v"), F.sum(F.coalesce("f", F.lit(0))).over(later).alias("f"))
        return left.filter(F.col("v") > 0).select("step", (F.col("v") - F.col("f")).alias("num_components"))

    def paths(self) -> DataFrame:
        """Average hops within the largest component at every step."""
        return average_path_length(self.edges, self._alive(self.vertices, 0), STEP, connected=self._alive(self.forest(), 0), lasting="death")

    def new_leaders(self, top_n: int = 3, max_iter: int = 10, weighted: bool = False) -> DataFrame:
        """Best zones by PageRank recomputed after every removal."""
        scores = pagerank_lasting(self.edges, self.vertices, range(1, self.k + 1), weighted, max_iter)
        place = F.row_number().over(Window.partitionBy("step").orderBy(*by_score("pagerank")))
        return scores.withColumn("place", place).filter(F.col("place") <= top_n)

    def timeline(self, paths: bool = True) -> DataFrame:
        """Flow, edges and components per step with drop, cumulative loss and first split."""
        rows = self.flow().join(self.components(), "step", "left")
        if paths:
            rows = rows.join(self.paths().select("step", "avg_path"), "step", "left")
        # k + 1 rows.
        order = Window.orderBy("step")
        drop = F.lag("remaining_flow_pct", 1, 100.0).over(order) - F.col("remaining_flow_pct")
        before = F.lag("num_components", 1).over(order)
        return rows.withColumn("flow_drop", drop).withColumn(
            "cumulative_loss", F.sum("flow_drop").over(order.rowsBetween(Window.unboundedPreceding, 0))
        ).withColumn("splits", F.coalesce((before == 1) & (F.col("num_components") > 1), F.lit(False)))

    def named_timeline(self, names: DataFrame, top_n: int = 3) -> DataFrame:
        """The timeline with the name of each removed zone and, in order, the names of the best zones afterwards; ``names`` has ``(id, name)``."""
        names = names.select("id", "name")
        leaders = self.new_leaders(top_n).join(names, "id", "left").groupBy("step").agg(
            F.array_sort(F.collect_list(F.struct("place", "name"))).alias("_best"))  # top_n rows per step
        rows = self.timeline(paths=False).join(names.withColumnsRenamed({"id": "removed_id", "name": "removed_name"}), "removed_id", "left")
        return rows.join(leaders, "step", "left").withColumn("new_leaders", F.transform("_best", lambda b: b["name"])).drop("_best")
