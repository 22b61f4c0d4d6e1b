"""Weak and strong components by minimum-label propagation with pointer jumping; spanning forests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowatlas.operators import inside as one_task, skew
from flowatlas.operators.adjacency import Adjacency, both_ways, vertex_ids, with_loops
from flowatlas.operators.skew import join_unique
from flowatlas.session import settle, store


#: Share of its vertices that a round of peeling has to take for another one.
TRIM_SHARE = 0.1


def _smallest_reaching(edges: DataFrame, vertices: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """For every vertex the smallest id that has a path to it (itself included).

    Each round takes the minimum over two hops of incoming edges and then replaces a label by the
    label of the vertex it names, which is also a vertex with a path to here. The jump doubles the
    distance a label has travelled, so the number of rounds is logarithmic on long chains. Small graphs make all rounds in one task.
    """
    vertices = settle(vertices.select(*keys, "id"))
    rows = vertices.count()
    if one_task.integral(edges, *keys, "src", "dst") and one_task.integral(vertices, *keys, "id") and skew.fits_task(rows) and skew.fits_task(rows + edges.count()):
        return one_task.smallest_reaching(edges, vertices, keys)
    links = Adjacency(with_loops(edges.select(*keys, "src", "dst"), vertices, {}), rows, keys)
    state = vertices.select(*keys, "id", F.col("id").alias("label"), F.col("id").alias("start"))
    while True:
        for _ in range(2):
            state = (
                links.push(state).groupBy(*keys, F.col("dst").alias("id"))
                .agg(F.min("label").alias("label"), F.max(F.when(F.col("loop"), F.col("start"))).alias("start"))
            )
        state = store(state)
        if state.filter(F.col("label") != F.col("start")).isEmpty():
            links.release()
            return state.select(*keys, "id", "label")
        # Many vertices share a label; the named side has one row per vertex.
        named = state.select(*keys, F.col("id").alias("label"), F.col("label").alias("further"))
        state = join_unique(state, named, [*keys, "label"], rows, big_rows=rows).select(
            *keys, "id", F.col("further").alias("label"), F.col("further").alias("start")
        )


def weak_components(edges: DataFrame, vertices: DataFrame | None = None,
                    keys: tuple[str, ...] = ()) -> DataFrame:
    """``(keys..., id, component)``; a component is named by its smallest member."""
    if vertices is None:
        vertices = vertex_ids(edges, keys)
    if not keys:
        vertices = settle(vertices.select("id"))
        edges = _thinned(edges, vertices)
    labels = _smallest_reaching(both_ways(edges, *keys), vertices, keys)
    return labels.withColumnRenamed("label", "component")


#: Edges per vertex from which a graph is thinned out before its components are sought.
DENSE = 8


def _thinned(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """Fewer edges that connect the same vertices, where there are many to a vertex and tasks can hold all vertices: rounds over all edges would write them several times."""
    if not one_task.integral(edges, "src", "dst"):
        return edges
    left, rows = edges.count(), vertices.count()
    if not skew.fits_task(rows):
        return edges
    while left > DENSE * rows and not skew.fits_task(left):
        tasks = max(-(-left // one_task.EDGES_AT_ONCE), edges.sparkSession.sparkContext.defaultParallelism)
        edges = one_task.stars(edges.coalesce(tasks))
        before, left = left, edges.count()
        if 2 * left > before:
            break
    return edges


def _trimmed(edges: DataFrame) -> DataFrame:
    """Edges that are left when vertices without incoming or without outgoing edges are peeled off.

    Such a vertex is a component of its own. Degrees are counted once; then only vertices that were peeled send along their edges what their
    neighbours lose. Peeling ends when a round finds fewer than one in ``1 / TRIM_SHARE`` vertices: what is left of long chains is
    cheaper to separate by labels, which travel twice as far every round.
    """
    degree = edges.select(F.explode(F.array(
        F.struct(F.col("src").alias("id"), F.lit(0).alias("came"), F.lit(1).alias("left")),
        F.struct(F.col("dst").alias("id"), F.lit(1).alias("came"), F.lit(0).alias("left")),
    )).alias("e")).groupBy("e.id").agg(F.sum("e.came").alias("came"), F.sum("e.left").alias("left"))
    state = store(degree)
    rows, links, peeled = state.count(), None, 0
    stuck = (F.col("came") <= 0) | (F.col("left") <= 0)
    while True:
        gone = state.filter(stuck)
        n = gone.count()
        peeled += n
        if n == 0 or n < TRIM_SHARE * rows:
            break
        if links is None:
            # way 0: the target loses an incoming edge; way 1, the edge reversed: its source loses an outgoing one.
            links = Adjacency(edges.select(F.explode(F.array(
                F.struct(F.lit(0).alias("way"), F.col("src"), F.col("dst")),
                F.struct(F.lit(1).alias("way"), F.col("dst").alias("src"), F.col("src").alias("dst")),
            )).alias("e")).select("e.*"), 2 * rows, ("way",))
        sent = links.push(gone.select(F.explode(F.array(F.lit(0), F.lit(1))).alias("way"), "id")).groupBy(F.col("dst").alias("id")).agg(
            F.sum(F.when(F.col("way") == 0, 1).otherwise(0)).alias("less_came"),
            F.sum(F.when(F.col("way") == 1, 1).otherwise(0)).alias("less_left"))
        state = store(state.filter(~stuck).join(sent, "id", "left").select(
            "id", (F.col("came") - F.coalesce("less_came", F.lit(0))).alias("came"),
            (F.col("left") - F.coalesce("less_left", F.lit(0))).alias("left")))
    if links is not None:
        links.release()
    return edges if not peeled else store(_between(edges, state.filter(~stuck).select("id"), rows))


def largest_groups(groups: DataFrame, label: str, shown: int = 5) -> DataFrame:
    """``(rank, label, size)`` of the ``shown`` largest groups, smaller labels first among equals; cut in every task before they meet."""
    best = group_sizes(groups, label).orderBy(F.desc("size"), label).limit(shown)
    place = F.row_number().over(Window.orderBy(F.desc("size"), label))  # ``shown`` rows
    return best.select(place.alias("rank"), label, "size")


def _between(edges: DataFrame, vertices: DataFrame, rows: int) -> DataFrame:
    """Edges with both ends among ``vertices`` (unique ids, at most ``rows``)."""
    kept = join_unique(edges, vertices.withColumnRenamed("id", "src"), ["src"], rows)
    return join_unique(kept, vertices.withColumnRenamed("id", "dst"), ["dst"], rows).select("src", "dst")


def _labelled(edges: DataFrame, labels: DataFrame, rows: int, edge_rows: int | None = None) -> DataFrame:
    """Edges with the labels ``(id, label)`` of both ends as ``a`` and ``b``; sparse edges, if counted, are shuffled."""
    one = join_unique(edges, labels.select(F.col("id").alias("src"), F.col("label").alias("a")), ["src"], rows, big_rows=edge_rows)
    return join_unique(one, labels.select(F.col("id").alias("dst"), F.col("label").alias("b")), ["dst"], rows, big_rows=edge_rows)


def strong_components(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """``(id, component)``: vertices that reach each other, named by the smallest member.

    Every round peels vertices off (``_trimmed``), then colours each vertex with the smallest vertex that reaches it. Components lie
    within one colour, so edges between colours go. Backwards, inside the colours that are left, each vertex finds the smallest vertex it
    reaches; if that is the one its colour is named after, the vertex belongs to that one's component. The next round takes the edges between
    vertices that are still open and agree on both answers. Small graphs are searched in one task.
    """
    if vertices is None:
        vertices = vertex_ids(edges)
    rest = store(edges.filter(F.col("src") != F.col("dst")).select("src", "dst").distinct())
    small = one_task.integral(rest, "src", "dst") and skew.fits_task(rest.count())
    found = [one_task.strong_members(rest)] if small else _strong_rounds(rest)
    if not found:
        return vertices.select("id", F.col("id").alias("component"))
    members = reduce(DataFrame.unionByName, found)
    return vertices.select("id").join(members, "id", "left").select(
        "id", F.coalesce("component", "id").alias("component")
    )


def _strong_rounds(rest: DataFrame) -> list[DataFrame]:
    """``(id, component)`` of the vertices each round has settled."""
    found: list[DataFrame] = []
    while True:
        rest = _trimmed(rest)
        if rest.isEmpty():
            break
        inner = settle(vertex_ids(rest))
        rows = inner.count()
        colours = _smallest_reaching(rest, inner, ())
        inside = store(_labelled(rest, colours, rows).filter(F.col("a") == F.col("b")).select("src", "dst"))
        reached = _smallest_reaching(inside.select(F.col("dst").alias("src"), F.col("src").alias("dst")), inner, ())
        both = store(colours.join(reached.withColumnRenamed("label", "low"), "id"))
        found.append(both.filter(F.col("label") == F.col("low")).select("id", F.col("label").alias("component")))
        open_ = both.filter(F.col("label") != F.col("low")).select("id", F.col("low").alias("label"))
        rest = store(_labelled(inside, open_, rows).filter(F.col("a") == F.col("b")).select("src", "dst"))
    return found


def spanning_forest(edges: DataFrame, order: str) -> DataFrame:
    """``(src, dst, order)``: a maximum spanning forest of the undirected graph by the column ``order``.

    Borůvka rounds: every component takes the greatest edge that leaves it (equal ones by their ends, so no
    cycle can close), components tied by such edges become one, and of the edges between two components the greatest stays. Each round
    at least halves the number of components, and edges inside a component go. Small graphs take their edges in order inside one task. For every bound s, the forest edges
    above s connect the same vertices as all edges above s.
    """
    low, high = F.least("src", "dst"), F.greatest("src", "dst")
    pairs = edges.filter(F.col("src") != F.col("dst")).groupBy(low.alias("src"), high.alias("dst")).agg(F.max(order).alias(order))
    rest = store(pairs.select("src", "dst", F.struct(F.col(order).alias("value"), (-F.col("src")).alias("low"), (-F.col("dst")).alias("high")).alias("edge")))
    if one_task.integral(rest, "src", "dst") and skew.fits_task(left := rest.count()):
        return one_task.spanning_forest(rest.select("src", "dst", F.col("edge.value").alias(order)), order) if left else pairs
    found: list[DataFrame] = []
    while left := rest.count():
        best = rest.select(F.explode(F.array("src", "dst")).alias("end"), F.struct("edge", "src", "dst").alias("x")).groupBy("end").agg(F.max("x").alias("x"))
        chosen = store(best.select("x.*").distinct())
        found.append(chosen.select((-F.col("edge.low")).alias("src"), (-F.col("edge.high")).alias("dst"), F.col("edge.value").alias(order)))
        joined = store(weak_components(chosen.select("src", "dst")).withColumnRenamed("component", "label"))
        rest = store(_labelled(rest, joined, joined.count(), left).filter(F.col("a") != F.col("b"))
                     .groupBy(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).agg(F.max("edge").alias("edge")))
    if not found:
        return pairs
    return reduce(DataFrame.unionByName, found)


def group_sizes(groups: DataFrame, column: str) -> DataFrame:
    """Members per component or community."""
    return groups.groupBy(column).agg(F.count("*").alias("size"))


def largest_component(edges: DataFrame, vertices: DataFrame | None = None,
                      keys: tuple[str, ...] = ()) -> DataFrame:
    """Vertices of the largest weak component per key; ties go to the smaller name."""
    groups = weak_components(edges, vertices, keys)
    sizes = groups.groupBy(*keys, "component").agg(F.count("*").alias("size"))
    best = F.max(F.struct(F.col("size"), (-F.col("component")).alias("minus"))).alias("best")
    chosen = sizes.groupBy(*keys).agg(best).select(*keys, (-F.col("best.minus")).alias("component"))
    # One row per key: the number of graphs side by side.
    return groups.join(F.broadcast(chosen), [*keys, "component"], "left_semi").select(*keys, "id")
