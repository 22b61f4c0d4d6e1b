"""Shortest paths from many sources at once: average length and betweenness."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowatlas.operators.adjacency import both_ways, vertex_ids
from flowatlas.operators import blocks as laid_out
from flowatlas.operators.blocks import MAX_WIDTH, Blocks, Unit, matrix, packed, runs, unpacked
from flowatlas.operators.components import largest_component
from flowatlas.session import discard, settle, shuffles_released

#: (source, vertex) pairs that are held at once, about.
ROWS_PER_BATCH = 200_000_000


def average_path_length(edges: DataFrame, vertices: DataFrame | None = None, keys: tuple[str, ...] = (),
                        rows_per_batch: int = ROWS_PER_BATCH, connected: DataFrame | None = None, lasting: str | None = None) -> DataFrame:
    """Mean number of hops between vertices of the largest component, edges taken both ways.

    Null when that component has a single vertex. All sources are used, as bits (``total_hops``); on large components they run
    in as many batches as keep the (source, vertex) pairs of one batch near ``rows_per_batch``. ``connected`` may hold fewer edges that
    connect the same vertices, such as a spanning forest, to find the component with. With ``lasting`` edges have no key (``Blocks``), only
    ``connected``, which is needed then, has.
    """
    core = settle(largest_component(edges if connected is None else connected, vertices if vertices is not None else vertex_ids(edges, keys), keys))
    # Repeated edges stay: a hop over them is the same hop.
    linked = edges.filter(F.col("src") != F.col("dst"))
    if lasting:
        hops = both_ways(linked, lasting)  # edges outside the component are met by none of its vertices
    else:
        hops = both_ways(linked, *keys).join(core.select(*keys, F.col("id").alias("src")), [*keys, "src"], "left_semi")
    totals = total_hops(hops, core, keys, rows_per_batch, lasting)
    sizes = core.groupBy(*keys).agg(F.count("*").alias("core_size"))
    if keys:
        joined = sizes.join(totals, list(keys), "left")
    else:
        joined = sizes.withColumn("total", totals.scalar())
    pairs = (F.col("core_size") * (F.col("core_size") - 1)).cast("double")
    return joined.select(*keys, "core_size", (F.col("total") / F.nullif(pairs, F.lit(0.0))).alias("avg_path"))


#: Sources that a row holds as bits, 64 in each word.
WORDS = 64
SENT = "chunk int, block int, origin string, rows binary, moved binary"


def _spread(source: np.ndarray, target: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Targets (ascending in ``target``) and the bits of ``fresh`` that come to them."""
    rows, pieces = runs(target, fresh.shape[1])
    found = np.zeros((len(rows), fresh.shape[1]), np.uint64)
    for i, a, b in pieces:
        found[i] |= np.bitwise_or.reduce(fresh[source[a:b]], axis=0)
    return rows, found


def _bits_sent(words: int):
    """Which sources reach the targets of a unit's edges: the bits of the ends they come from. Targets that all sources have reached are passed over."""
    def send(unit: Unit, age: int | None, own: pd.Series, there: pd.Series | None) -> tuple[np.ndarray, np.ndarray]:
        fresh = matrix(own["fresh"], np.uint64, words)
        live = fresh.any(axis=1)[unit.source]
        if there is not None and there["wanting"] is not None:
            live &= unpacked(there["wanting"], np.bool_)[unit.target]
        if unit.last is not None:
            live &= unit.alive(age)
        return _spread(unit.source[live], unit.target[live], fresh)
    return send


BITS = "chunk int, block int, reached binary, fresh binary, wanting binary, every binary, hops long, live boolean, open boolean"


def _start_bits(words: int, size: int, keys: list[str]):
    def start(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros((size, words), np.uint64)
        at = rows["column"].to_numpy(np.int64)
        bits[rows["row"].to_numpy(np.int64), at // 64] = np.uint64(1) << (at % 64).astype(np.uint64)
        return pd.DataFrame([(*key, packed(bits))], columns=[*keys, "chunk", "block", "reached"])
    return start


def _every_source(words: int, keys: list[str]):
    """The bits of all sources of a block."""
    def gather(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        every = np.zeros(words, np.uint64)
        for blob in rows["reached"]:
            every |= np.bitwise_or.reduce(matrix(blob, np.uint64, words), axis=0)
        return pd.DataFrame([(*key, every.tobytes())], columns=[*keys, "block", "every"])
    return gather


def _meet_bits(words: int, size: int, keys: list[str], depth: int):
    """One more hop: what is new among the bits that arrived, and hops for it."""
    def meet(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        known, sent = rows[rows["origin"] == ""], rows[rows["origin"] != ""]
        reached = np.zeros((size, words), np.uint64) if known["reached"].iloc[0] is None else matrix(known["reached"].iloc[0], np.uint64, words)
        hops, every = int(known["hops"].iloc[0]), np.frombuffer(known["every"].iloc[0], np.uint64)
        fresh = np.zeros_like(reached)
        for at, moved in zip(sent["rows"], sent["moved"]):
            fresh[unpacked(at, np.int32)] |= unpacked(moved, np.uint64).reshape(-1, words)
        fresh &= ~reached
        found = int(np.bitwise_count(fresh).sum())
        reached |= fresh
        wanting = (reached != every).any(axis=1)
        return pd.DataFrame([(*key, packed(reached), packed(fresh), packed(wanting), known["every"].iloc[0], hops + depth * found, found > 0, bool(wanting.any()))],
                            columns=[*keys, *_columns(BITS)])
    return meet


def _components(source: np.ndarray, target: np.ndarray, n: int) -> np.ndarray:
    """The smallest vertex of every vertex's component; edges go both ways."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, target, label[source])
        label = np.minimum(label, label[label])
        label = label[label]
        if np.array_equal(before, label):
            return label


def _peel(source: np.ndarray, target: np.ndarray, n: int) -> tuple[int, np.ndarray]:
    """Takes off leaves until none is left, of a graph of different edges both ways without loops.

    A leaf, with all that were taken off behind it, is on one side of its last edge and the rest of its component on the other: every path between them takes
    that edge once. Hops over all such edges, in both directions, and how many vertices stand at every vertex that is left (0 for the others).
    """
    whole = np.bincount(_components(source, target, n), minlength=n)[_components(source, target, n)]
    degree, weight = np.bincount(target, minlength=n), np.ones(n, np.int64)
    beside = np.zeros(n, np.int64)  # the neighbours that are left, xor-ed: of a leaf, the only one
    np.bitwise_xor.at(beside, target, source.astype(np.int64))
    hops, leaf = 0, np.flatnonzero(degree == 1)
    while len(leaf):
        stem = beside[leaf]
        one = (degree[stem] > 1) | (leaf > stem)  # two leaves beside each other: one goes
        leaf, stem = leaf[one], stem[one]
        hops += int((2 * weight[leaf] * (whole[leaf] - weight[leaf])).sum())
        np.add.at(weight, stem, weight[leaf])
        np.subtract.at(degree, stem, 1)
        np.bitwise_xor.at(beside, stem, leaf)
        weight[leaf], degree[leaf] = 0, 0
        leaf = np.unique(stem)
        leaf = leaf[degree[leaf] == 1]
    weight[degree == 0] = 0
    return hops, weight


CORE = "total long, s binary, d binary, weight binary, sources int"


def _cores(keys: list[str], size: int, lasting: bool):
    """Of a graph whose edges are one packed row: the hops that lead over edges to leaves, and the packed edges and weights of what is left without them."""
    def cores(batches):
        for batch in batches:
            for _, row in batch.iterrows():
                unit = Unit(row, size)
                alive = unit.alive(row[keys[0]] if lasting else None)
                inside = np.zeros(size, bool)
                inside[unpacked(row["at"], np.int32)] = True
                source, target = unit.source[alive].astype(np.int64), unit.target[alive].astype(np.int64)
                both = inside[source] & (source != target)
                edge = np.unique(target[both] * size + source[both])
                target, source = edge // size, edge % size
                hops, weight = 0, inside.astype(np.int64)
                if np.array_equal(np.sort(source * size + target), edge):
                    hops, weight = _peel(source, target, size)
                left = np.flatnonzero(weight)
                place = np.cumsum(weight > 0) - 1
                kept = (weight[source] > 0) & (weight[target] > 0)
                yield pd.DataFrame([(*[row[c] for c in keys], hops, packed(place[source[kept]].astype(np.int32)), packed(place[target[kept]].astype(np.int32)), packed(weight[left]), len(left))],
                                   columns=[*keys, *_columns(CORE)])
    return cores


def _all_hops(keys: list[str]):
    """Breadth first to the end from the sources of a lot, a block of them after another, counted by the weights of both ends."""
    def search(batches):
        for batch in batches:
            for _, row in batch.iterrows():
                weight = unpacked(row["weight"], np.int64)
                source, target, n = unpacked(row["s"], np.int32), unpacked(row["d"], np.int32), len(weight)
                plain, total = bool((weight == 1).all()), 0
                wide = 64 * max(1, min(WORDS, laid_out.CELLS // max(1, n)))
                begin, end = n * row["lot"] // row["lots"], n * (row["lot"] + 1) // row["lots"]
                for first in range(begin, end, wide):
                    at = np.arange(min(wide, end - first))
                    reached = np.zeros((n, -(-len(at) // 64)), np.uint64)
                    reached[first + at, at // 64] = np.uint64(1) << (at % 64).astype(np.uint64)
                    every, fresh, depth = np.bitwise_or.reduce(reached, axis=0), reached.copy(), 0
                    while fresh.any():
                        depth += 1
                        some = fresh.any(axis=1)[source] & (reached != every).any(axis=1)[target]
                        rows, found = _spread(source[some], target[some], fresh)
                        found &= ~reached[rows]
                        fresh = np.zeros_like(reached)
                        fresh[rows] = found
                        reached[rows] |= found
                        total += depth * _weighed(found, weight[rows], weight[first + at], plain)
                yield pd.DataFrame([(*[row[c] for c in keys], total)], columns=[*keys, "hops"])
    return search


def _weighed(bits: np.ndarray, rows: np.ndarray, columns: np.ndarray, plain: bool) -> int:
    """Sum over all bits of the products of their row's and their column's weight."""
    if plain:
        return int(np.bitwise_count(bits).sum())
    total, step = 0, max(1, laid_out.STEP_CELLS // max(1, len(columns)))
    for a in range(0, len(rows), step):
        cells = np.unpackbits(bits[a:a + step].view(np.uint8), axis=1, bitorder="little")[:, :len(columns)]
        total += int((cells.astype(np.float64) @ columns.astype(np.float64)).astype(np.int64) @ rows[a:a + step])
    return total


def total_hops(hops: DataFrame, vertices: DataFrame, keys: tuple[str, ...] = (), rows_per_batch: int = ROWS_PER_BATCH,
               lasting: str | None = None) -> DataFrame:
    """``(keys..., total)``: hops from every vertex ``(keys..., id)`` to every vertex it reaches over ``hops`` ``(keys..., src, dst)``, added up.

    Breadth first from all sources of a batch together, on matrices of bits (``blocks``): which of the block's sources reach a vertex, and which did so in
    the last round. Only the latter are sent, and only to vertices that some source has not reached. Where the graph of every key fits one row of packed edges, its
    rounds run inside a task: long sparse graphs take as many rounds as their longest path has hops. There trees are taken off first (``_peel``), whose
    paths need no search.
    """
    with shuffles_released(vertices.sparkSession):
        return _total_hops(hops, vertices, keys, rows_per_batch, lasting)


def _total_hops(hops: DataFrame, vertices: DataFrame, keys: tuple[str, ...], rows_per_batch: int, lasting: str | None) -> DataFrame:
    types = dict(vertices.dtypes)
    named = "".join(f"{c} {types[c]}, " for c in keys)
    vertices = settle(vertices.select(*keys, "id").distinct())
    rows, n = vertices.count(), vertices.select("id").distinct().count()
    hops = hops if lasting else hops.select(*keys, "src", "dst")
    # A few edges may have many vertices: as many as one matrix has rows.
    most = hops.groupBy(*([] if lasting else keys)).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    words = max(1, min(WORDS, -(-n // 64), laid_out.CELLS // max(1, n) if most <= laid_out.EDGES_PER_UNIT else WORDS))
    graph = Blocks(hops, vertices, words, keys, lasting)
    # Graphs of a single vertex have nothing to add up.
    none = vertices.select(*keys).distinct() if keys else vertices.sparkSession.range(1)
    nothing = none.select(*keys, F.lit(0).cast("long").alias("hops"))
    if graph.single:
        sums = [settle(_hops_inside(graph, vertices, keys, named))]
    else:
        sums = _hops_outside(graph, vertices, keys, named, words, n, rows, rows_per_batch)
    graph.drop()
    found = reduce(DataFrame.unionByName, [*sums, nothing])
    return settle(found.groupBy(*keys).agg(F.sum("hops").alias("total")))


def _hops_inside(graph: Blocks, vertices: DataFrame, keys: tuple[str, ...], named: str) -> DataFrame:
    """Each graph's rounds inside tasks, of which each has a share of the sources."""
    def members(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(*key, packed(rows["row"].to_numpy(np.int32)))], columns=[*keys, "at"])

    names = list(keys)
    spark = vertices.sparkSession
    at = vertices.join(graph.places, "id").select(*names, "row").groupBy(*names).applyInPandas(members, f"{named}at binary")
    edges = graph.edges.drop("a", "b", "part")
    ready = at.crossJoin(edges) if graph.lasting or not names else at.join(edges, names)
    cores = settle(ready.repartition(max(1, min(graph.graphs if graph.lasting else graph.units, MAX_WIDTH)), *names).mapInPandas(_cores(names, graph.size, graph.lasting), f"{named}{CORE}"))
    side = max(1, cores.count())
    lots = F.greatest(F.lit(1), F.least(F.ceil(F.col("sources") / 64), F.lit(-(-2 * spark.sparkContext.defaultParallelism // side)))).cast("int")
    dealt = cores.withColumn("lots", lots).withColumn("lot", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)))
    found = dealt.repartition(max(1, min(2 * side * -(-2 * spark.sparkContext.defaultParallelism // side), MAX_WIDTH)), *names, "lot").mapInPandas(_all_hops(names), f"{named}hops long")
    return found.unionByName(cores.select(*names, F.col("total").alias("hops")))


def _hops_outside(graph: Blocks, vertices: DataFrame, keys: tuple[str, ...], named: str, words: int, n: int, rows: int, rows_per_batch: int) -> list[DataFrame]:
    """A round of messages for every hop."""
    names = list(keys)
    blocks = -(-n // (64 * words))
    batches = max(1, min(blocks, -(-n * rows // (8 * rows_per_batch))))  # a pair takes two bits
    per = max(1, -(-blocks // batches))
    at = (F.col("place") % (64 * words)).cast("int").alias("column")
    begun = settle(vertices.join(graph.places, "id").select(*names, "chunk", F.floor(F.col("place") / (64 * words)).cast("int").alias("block"), "row", at)
                   .groupBy(*names, "chunk", "block").applyInPandas(_start_bits(words, graph.size, names), f"{named}chunk int, block int, reached binary"))
    every = settle(begun.groupBy(*names, "block").applyInPandas(_every_source(words, names), f"{named}block int, every binary"))
    chunks = F.explode(F.sequence(F.lit(0), F.lit(graph.chunks - 1))).alias("chunk")
    sums = []
    graph.lay(per)
    for first in range(0, blocks, per):
        some = F.col("block").between(first, min(first + per, blocks) - 1)
        # A row for every chunk: those without a source may be reached.
        state = settle(every.filter(some).select("*", chunks).join(begun.filter(some), [*names, "chunk", "block"], "left").select(
            *names, "chunk", "block", "reached", F.col("reached").alias("fresh"), F.lit(None).cast("binary").alias("wanting"), "every", F.lit(0).cast("long").alias("hops"),
            F.col("reached").isNotNull().alias("live"), F.lit(True).alias("open")))
        depth = 0
        while True:
            depth += 1
            fresh = state.filter("live").select(*names, "chunk", "block", "fresh")
            sent = graph.push(fresh, _bits_sent(words), f"{named}{SENT}", state.filter("open").select(*names, "chunk", "block", "wanting"))
            state = graph.combine(state, sent, _meet_bits(words, graph.size, names, depth))
            # A block goes on as long as something came to it and some vertex wants more.
            if state.groupBy(*names, "block").agg((F.bool_or("live") & F.bool_or("open")).alias("go")).filter("go").isEmpty():
                break
        sums.append(settle(state.groupBy(*names).agg(F.sum("hops").alias("hops"))))
        discard(state)
    return sums


def path_cost(kind: str) -> Column:
    """Edge cost: ``weight`` takes the trip count as length, so busy routes are long."""
    return {
        "weight": F.col("weight").cast("long"),
        "hops": F.lit(1).cast("long"),
        "inverse": F.lit(1.0) / F.col("weight"),
    }[kind]


def pivots(vertices: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """``k`` repeatable sources: the smallest hashes of (id, seed)."""
    return vertices.select("id").orderBy(F.md5(F.concat_ws("#", "id", F.lit(seed))), "id").limit(k)


#: Sources of a block, at most.
SOURCES = 512
#: Bytes of messages that a round has on disk at once, about, before they are compressed; a block of sources takes a quarter of it at most.
ROUND_BYTES = 1 << 30
DISTANCES = "chunk int, block int, dist binary, fresh binary, live boolean"
SUMS = "chunk int, block int, dist binary, kept binary, x binary, total binary, live boolean"


def _columns(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def betweenness(edges: DataFrame, cost: str = "weight", sample: int | None = None, seed: int = 42,
                rows_per_batch: int = ROWS_PER_BATCH) -> DataFrame:
    """``(id, betweenness)``, directed and normalised by (n-1)(n-2).

    Exact at any size; with ``sample=k`` from k sources, scaled by n/k. Sources run in blocks, as many at once as keep their (source, vertex) cells near
    ``rows_per_batch`` and the messages of a round near ``ROUND_BYTES``. Rows (source, target, vertex) or (source, vertex) are never made: a state row holds a matrix of
    a chunk of vertices and a block of sources. Every chunk's state goes to every chunk it has edges to, so messages grow with the square of a block's width: large graphs have
    narrow blocks.

    With D the distances, an edge (u, v) is tight for s when D(s,u) + cost = D(s,v). Shortest-path
    counts are sums over tight edges, hop by hop; the dependency of s on v is
    ``count(v) * g(v) - 1`` with ``g(v) = 1/count(v) + sum of g over tight successors``, the same
    kind of sum backwards. Both are rounds of messages between chunks (``blocks``).
    """
    with shuffles_released(edges.sparkSession):
        return _betweenness(edges, cost, sample, seed, rows_per_batch)


def _message_bytes(n: int, wide: int) -> int:
    """What a round sends for a block of ``wide`` sources on a graph of ``n`` vertices."""
    return 8 * n * wide * max(1, -(-n * wide // laid_out.CELLS))


def _betweenness(edges: DataFrame, cost: str, sample: int | None, seed: int, rows_per_batch: int) -> DataFrame:
    vertices = settle(vertex_ids(edges))
    n = vertices.count()
    k = min(sample or n, n)
    wide = max(1, min(SOURCES, k))
    while wide > 16 and _message_bytes(n, wide) > ROUND_BYTES // 4:
        wide = wide * 3 // 4
    priced = edges.select("src", "dst", path_cost(cost).alias("cost"))
    kind = np.int64 if dict(priced.dtypes)["cost"] == "bigint" else np.float64
    graph = Blocks(priced, vertices, wide)
    if k >= n:
        at = graph.places.select("id", "chunk", "row", "place")
    else:
        chosen = F.row_number().over(Window.orderBy("id")) - 1  # k rows
        at = pivots(vertices, k, seed).select("id", chosen.alias("at")).join(graph.places.drop("place"), "id").withColumnRenamed("at", "place")
    sources = settle(at.select("chunk", F.floor(F.col("place") / wide).cast("int").alias("block"), "row", (F.col("place") % wide).cast("int").alias("column")))
    blocks = -(-k // wide)
    per = max(1, min(rows_per_batch // max(1, n * wide), ROUND_BYTES // max(1, _message_bytes(n, wide))))
    parts = [settle(vertices.select("id", F.lit(0.0).alias("raw")).limit(0))]
    graph.lay(max(1, min(per, blocks)))
    for first in range(0, blocks if sources.count() else 0, per):
        parts.append(_dependencies(graph, sources, range(first, min(first + per, blocks)), wide, kind))
        if len(parts) > MERGED_PARTS:
            merged = settle(_added(parts))
            for part in parts:
                discard(part)
            parts = [merged]
    graph.drop()
    scale = (n / max(k, 1)) / ((n - 1) * (n - 2)) if n > 2 else 0.0
    return settle(vertices.join(_added(parts), "id", "left").select(
        "id", (F.coalesce("raw", F.lit(0.0)) * F.lit(scale)).alias("betweenness")
    ))


#: Tables of dependencies of batches that wait to be added up.
MERGED_PARTS = 32


def _added(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).groupBy("id").agg(F.sum("raw").alias("raw"))


def _dependencies(graph: Blocks, sources: DataFrame, blocks: range, wide: int, kind: type) -> DataFrame:
    """``(id, raw)``: dependency of the sources of some blocks on every vertex, summed."""
    on = ["chunk", "block"]
    chosen = sources.filter(F.col("block").between(blocks.start, blocks.stop - 1))
    state = settle(chosen.groupBy(*on).applyInPandas(_start_distances(wide, kind, graph.size), DISTANCES))
    while not state.filter("live").isEmpty():
        sent = graph.push(state.filter("live").select(*on, "dist", "fresh"), _relax(wide, kind), SENT, cost=kind)
        state = graph.combine(state, sent, _nearer(wide, kind, graph.size))

    def summed(state: DataFrame, back: bool) -> DataFrame:
        while not state.filter("live").isEmpty():
            sent = graph.push(state.filter("live").select(*on, "dist", "x"), _tight(wide, kind, back), SENT, state.select(*on, "dist"), back, kind)
            state = graph.combine(state, sent, _add(wide))
        return state

    paths = summed(settle(state.select(*on, "dist").groupBy(*on).applyInPandas(_start_counts(wide, kind), SUMS)), False)
    discard(state)
    back = summed(settle(paths.select(*on, "dist", "total").groupBy(*on).applyInPandas(_start_back(wide, kind), SUMS)), True)
    discard(paths)
    raw = back.select(*on, "dist", "kept", "total").groupBy(*on).applyInPandas(_raw(wide, kind), "chunk int, row int, raw double")
    out = settle(raw.groupBy("chunk", "row").agg(F.sum("raw").alias("raw")).join(graph.places, ["chunk", "row"]).select("id", "raw"))
    discard(back)
    return out


def _far(kind: type):
    return np.inf if kind is np.float64 else 1 << 62


def _start_distances(wide: int, kind: type, size: int):
    def start(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        dist, fresh = np.full((size, wide), _far(kind), kind), np.zeros(size, np.uint8)
        dist[rows["row"], rows["column"]] = 0
        fresh[rows["row"]] = 1
        return pd.DataFrame([(*key, packed(dist), packed(fresh), True)], columns=_columns(DISTANCES))
    return start


def _relax(wide: int, kind: type):
    """Shortest distances over a unit's edges from vertices that came nearer."""
    def send(unit: Unit, age: int | None, own: pd.Series, there: pd.Series | None) -> tuple[np.ndarray, np.ndarray]:
        dist = matrix(own["dist"], kind, wide)
        live = (unpacked(own["fresh"], np.uint8) > 0)[unit.source]
        source, cost = unit.source[live], unit.cost[live, None]
        rows, pieces = runs(unit.target[live], wide)
        found = np.full((len(rows), wide), _far(kind), kind)
        for i, a, b in pieces:
            np.minimum(found[i], (dist[source[a:b]] + cost[a:b]).min(axis=0), out=found[i])
        return rows, found
    return send


def _nearer(wide: int, kind: type, size: int):
    def meet(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        known, sent = rows[rows["origin"] == ""], rows[rows["origin"] != ""]
        dist = matrix(known["dist"].iloc[0], kind, wide) if len(known) else np.full((size, wide), _far(kind), kind)
        fresh = np.zeros(size, np.uint8)
        for at, moved in zip(sent["rows"], sent["moved"]):
            at, offer = unpacked(at, np.int32), unpacked(moved, kind).reshape(-1, wide)
            now = dist[at]
            fresh[at] |= (offer < now).any(axis=1)
            dist[at] = np.minimum(now, offer)
        return pd.DataFrame([(*key, packed(dist), packed(fresh), bool(fresh.any()))], columns=_columns(DISTANCES))
    return meet


def _start_counts(wide: int, kind: type):
    def start(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        blob = rows["dist"].iloc[0]
        x = (matrix(blob, kind, wide) == 0).astype(np.float64)
        return pd.DataFrame([(*key, blob, None, packed(x), packed(x), bool(x.any()))], columns=_columns(SUMS))
    return start


def _start_back(wide: int, kind: type):
    def start(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        blob, counts = rows["dist"].iloc[0], rows["total"].iloc[0]
        count = matrix(counts, np.float64, wide)
        x = np.divide(1.0, count, out=np.zeros_like(count), where=count > 0)
        return pd.DataFrame([(*key, blob, counts, packed(x), packed(x), bool(x.any()))], columns=_columns(SUMS))
    return start


def _tight(wide: int, kind: type, back: bool):
    """Sums of ``x`` over a unit's tight edges, from source to target or back."""
    def send(unit: Unit, age: int | None, own: pd.Series, there: pd.Series | None) -> tuple[np.ndarray, np.ndarray]:
        x, near, far = matrix(own["x"], np.float64, wide), matrix(own["dist"], kind, wide), matrix(there["dist"], kind, wide)
        order = unit.back() if back else slice(None)
        start, end = (unit.target[order], unit.source[order]) if back else (unit.source, unit.target)
        live = x.any(axis=1)[start]
        start, cost = start[live], unit.cost[order][live, None]
        rows, pieces = runs(end[live], wide)
        found = np.zeros((len(rows), wide))
        for i, a, b in pieces:
            at = start[a:b]
            # The same sum of the tail's distance and the cost either way.
            tight = (far[rows[i]] + cost[a:b] == near[at]) if back else (near[at] + cost[a:b] == far[rows[i]])
            found[i] += (x[at] * tight).sum(axis=0)
        return rows, found
    return send


def _add(wide: int):
    def meet(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        known, sent = rows[rows["origin"] == ""], rows[rows["origin"] != ""]
        row = known.iloc[0]  # tight edges end where a distance is known
        total = matrix(row["total"], np.float64, wide)
        x = np.zeros_like(total)
        for at, moved in zip(sent["rows"], sent["moved"]):
            x[unpacked(at, np.int32)] += unpacked(moved, np.float64).reshape(-1, wide)
        return pd.DataFrame([(*key, row["dist"], row["kept"], packed(x), packed(total + x), bool(x.any()))], columns=_columns(SUMS))
    return meet


def _raw(wide: int, kind: type):
    """Dependency of the block's sources on every vertex of the chunk that others reach it from."""
    def finish(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        row = rows.iloc[0]
        dist, count, g = matrix(row["dist"], kind, wide), matrix(row["kept"], np.float64, wide), matrix(row["total"], np.float64, wide)
        others = (count > 0) & (dist > 0)
        raw = np.where(others, count * g - 1.0, 0.0).sum(axis=1)
        at = np.flatnonzero(others.any(axis=1))
        return pd.DataFrame({"chunk": np.full(len(at), key[0]), "row": at, "raw": raw[at]})
    return finish
