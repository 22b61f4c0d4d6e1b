"""Communities: synchronous label propagation and Louvain, with their summaries."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from flowatlas.functions.scalar import uniform
from flowatlas.operators import skew
from flowatlas.operators.adjacency import Adjacency, both_ways, vertex_ids, with_loops
from flowatlas.operators.ordering import global_rank
from flowatlas.operators.skew import join_unique
from flowatlas.session import settle, store, widened


def label_propagation(edges: DataFrame, rounds: int = 5, vertices: DataFrame | None = None) -> DataFrame:
    """``(id, label)``: every round each vertex takes the most frequent label among its neighbours.

    Edges count in both directions, so a reciprocal pair counts twice. Ties take the smallest
    label. Loops carry the own label with no votes and only decide for vertices without neighbours.
    """
    if vertices is None:
        vertices = vertex_ids(edges)
    votes = both_ways(edges.withColumn("vote", F.lit(1)), "vote")
    vertices = settle(vertices.select("id"))
    links = Adjacency(with_loops(votes, vertices, {"vote": F.lit(0)}), vertices.count())
    state = vertices.select("id", F.col("id").alias("label"))
    with widened(edges.sparkSession, links.count):
        for _ in range(rounds):
            counted = links.push(state).groupBy("dst", "label").agg(F.sum("vote").alias("votes"))
            best = F.max(F.struct(F.col("votes"), (-F.col("label")).alias("minus"))).alias("best")
            state = settle(counted.groupBy(F.col("dst").alias("id")).agg(best).select("id", (-F.col("best.minus")).alias("label")))
    links.release()
    return state


def modularity(edges: DataFrame, groups: DataFrame) -> DataFrame:
    """One row ``modularity`` of a partition ``(id, label)`` of the undirected weighted graph."""
    double = both_ways(edges, "weight")
    source = groups.select(F.col("id").alias("src"), F.col("label").alias("a"))
    target = groups.select(F.col("id").alias("dst"), F.col("label").alias("b"))
    by_group = join_unique(join_unique(double, source, ["src"]), target, ["dst"]).groupBy("a").agg(
        F.sum("weight").cast("double").alias("tot"),
        F.sum(F.when(F.col("a") == F.col("b"), F.col("weight")).otherwise(0)).cast("double").alias("inside"),
    )
    whole = F.nullif(double.agg(F.sum("weight")).scalar().cast("double"), F.lit(0.0))
    return by_group.agg(F.sum("inside").alias("i"), F.sum(F.pow(F.col("tot"), F.lit(2.0))).alias("t2")).select(
        F.coalesce(F.col("i") / whole - F.col("t2") / (whole * whole), F.lit(0.0)).alias("modularity")
    )


#: Shares of the vertices with a better place that a round lets move, as long as modularity rises; below, they move apart from each other.
FIRST_SHARE, LAST_SHARE = 0.5, 1 / 64
#: Packed edges of a unit, at most about; those that are worth a task of their own in a round.
EDGES_PER_UNIT, EDGES_PER_TASK = 2_000_000, 200_000
#: Links (both directions) of a graph whose rounds one task makes: some 300 MB.
LINKS_INSIDE = 8_000_000


def louvain(edges: DataFrame, seed: int = 42, min_gain: float = 1e-9) -> DataFrame:
    """``(id, label)`` by modularity moves on the undirected graph and contraction, level by level.

    A level ends when no vertex has a move that raises modularity by more than ``min_gain``, and the levels end when one makes no
    move; there is no other bound on rounds or levels. Labels are the smallest member id.
    """
    # Symmetric weights; a contracted community keeps its inner weight as a loop.
    links = settle(both_ways(edges, "weight").groupBy("src", "dst").agg(F.sum("weight").cast("double").alias("w")))
    whole = links.agg(F.sum("w")).first()[0] or 0.0
    members = vertex_ids(edges).withColumn("node", F.col("id"))
    if whole == 0.0:
        return members.select("id", F.col("node").alias("label"))
    members = settle(members)
    level = 0
    while True:
        groups, values = local_moves(links, whole, f"{seed}-{level}", min_gain)
        if len(values) == 1:
            break
        groups = groups.select(F.col("id").alias("node"), "label")
        count = groups.count()
        members = store(join_unique(members, groups, ["node"], count).select("id", F.col("label").alias("node")))
        source = groups.withColumnsRenamed({"node": "src", "label": "a"})
        target = groups.withColumnsRenamed({"node": "dst", "label": "b"})
        links = store(
            join_unique(join_unique(links, source, ["src"], count), target, ["dst"], count)
            .groupBy(F.col("a").alias("src"), F.col("b").alias("dst")).agg(F.sum("w").alias("w"))
        )
        level += 1
    names = members.groupBy("node").agg(F.min("id").alias("label"))
    return join_unique(members, names, ["node"]).select("id", "label")


def local_moves(links: DataFrame, whole: float, seed: str, min_gain: float) -> tuple[DataFrame, list[float]]:
    """Partition ``(id, label)`` of one level and the modularity after every round, from single vertices on, always rising.

    All vertices are weighed in parallel. Moves made together may spoil each other, so a round lets a share of the
    vertices move, drawn by hash, and keeps the result only if modularity rises. If not, a smaller share tries; below ``LAST_SHARE``
    only vertices move of which no two leave or enter the same community. Their gains add up exactly, so such a round rises
    whenever there is any move to make.

    Graphs of at most ``LINKS_INSIDE`` links make all their rounds inside a task (``_rounds_inside``). Larger ones with up to ``skew.BROADCAST_ROWS`` vertices weigh
    them from edges packed once (``_weigh_packed``), beyond it by joins (``_weigh_joined``). The moves are the same.
    """
    kind = dict(links.dtypes)["src"]
    if skew.BROADCAST_ROWS > 0 and kind in ("bigint", "int") and links.count() <= LINKS_INSIDE:
        made = store(links.select(*[F.col(c).cast("long") for c in ("src", "dst")], "w").repartition(1).mapInArrow(
            _rounds_inside(whole, seed, min_gain, FIRST_SHARE, LAST_SHARE), "id long, label long, values array<double>"))
        return made.filter("values IS NULL").select(*[F.col(c).cast(kind).alias(c) for c in ("id", "label")]), made.filter("values IS NOT NULL").first()["values"]
    degree = links.groupBy(F.col("src").alias("id")).agg(F.sum("w").alias("k"))
    inner = links.filter(F.col("src") == F.col("dst")).agg(F.coalesce(F.sum("w"), F.lit(0.0))).first()[0]
    single = store(degree.select("id", "k", F.col("id").alias("label")))
    rows = single.count()
    weigh, release = (_weigh_packed if rows <= skew.BROADCAST_ROWS else _weigh_joined)(links, single, rows, whole, inner, min_gain)
    current, value, movers = weigh(single)
    values, share, turn = [value], FIRST_SHARE, 0
    while movers:
        apart = share < LAST_SHARE or share * movers < 1
        draw = F.concat_ws("#", "id", F.lit(turn), F.lit(seed))
        better = F.col("gain") > min_gain
        if apart:
            chosen = _apart(current.filter(better).select("id", "own", "target", F.xxhash64(draw).alias("place")))
            moved = current.join(chosen.withColumn("moves", F.lit(True)), "id", "left")
        else:
            moved = current.withColumn("moves", better & (uniform(draw) < share))
        trial, after, left = weigh(moved.select("id", "k", F.when(F.col("moves"), F.col("target")).otherwise(F.col("own")).alias("label")))
        turn += 1
        if after > value:
            current, value, movers = trial, after, left
            values.append(value)
            share = min(FIRST_SHARE, max(2 * share, LAST_SHARE))
        elif apart:
            break  # what is left to gain is lost in rounding
        else:
            share /= 8
    release()
    return current.select("id", F.col("own").alias("label")), values


#: Weighs a state ``(id, k, label)``: every vertex with its best community and gain; modularity of the partition; vertices that gain.
Weigh = Callable[[DataFrame], tuple[DataFrame, float, int]]


def _weigh_joined(links: DataFrame, single: DataFrame, rows: int, whole: float, inner: float, min_gain: float) -> tuple[Weigh, Callable[[], None]]:
    # The loop of weight 0 makes every vertex see its own community; edges carry the target's weight.
    between = with_loops(links.filter(F.col("src") != F.col("dst")), single.select("id"), {"w": F.lit(0.0)})
    weighed = join_unique(between, single.select(F.col("id").alias("dst"), "k"), ["dst"], rows)
    adjacency = Adjacency(weighed, rows)

    def weigh(state: DataFrame) -> tuple[DataFrame, float, int]:
        state = store(state)
        totals = state.groupBy("label").agg(F.sum("k").alias("tot"))
        offers = adjacency.push(state.select("id", "label")).groupBy("dst", "label").agg(
            F.sum("w").alias("w_in"), F.max("k").alias("k"), F.max("loop").alias("own"))
        offers = join_unique(offers, totals, ["label"], rows)
        tot = F.col("tot") - F.when(F.col("own"), F.col("k")).otherwise(0.0)
        gain = F.col("w_in") - tot * F.col("k") / F.lit(whole)
        picked = store(offers.groupBy(F.col("dst").alias("id")).agg(
            F.max("k").alias("k"),
            F.max(F.struct(gain.alias("gain"), (-F.col("label")).alias("minus"))).alias("best"),
            F.max(F.when(F.col("own"), gain)).alias("stay"),
            F.max(F.when(F.col("own"), F.col("w_in"))).alias("w_own"),
            F.max(F.when(F.col("own"), F.col("label"))).alias("own"),
        ).select("id", "k", "own", "w_own", (-F.col("best.minus")).alias("target"),
                 (2.0 * (F.col("best.gain") - F.col("stay")) / whole).alias("gain")))
        figures = picked.groupBy("own").agg(F.sum("k").alias("t"), F.sum("w_own").alias("i"), F.count_if(F.col("gain") > min_gain).alias("m")).agg(
            F.sum("i"), F.sum(F.col("t") * F.col("t")), F.sum("m")).first()
        return picked, (figures[0] + inner) / whole - figures[1] / (whole * whole), figures[2]

    return weigh, adjacency.release


def _weigh_packed(links: DataFrame, single: DataFrame, rows: int, whole: float, inner: float, min_gain: float) -> tuple[Weigh, Callable[[], None]]:
    """Vertices are dealt by hash over units, each with the edges of its vertices, at most about ``EDGES_PER_UNIT``, in one row.

    A unit is sent the communities of all vertices, so a round is one narrow pass over packed edges; nothing per edge is shuffled.
    """
    spark = links.sparkSession
    edges = settle(links.filter(F.col("src") != F.col("dst")))
    count = edges.count()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    units = max(1, -(-count // EDGES_PER_UNIT), min(tasks, -(-count // EDGES_PER_TASK)))
    place = (F.col("place") - 1).cast("int")
    ids = single.filter(F.col("id").isNotNull()).select("id")
    places = settle(global_rank(ids, [F.col("id")], "place").select(
        "id", place.alias("place"), F.pmod(F.xxhash64("id"), F.lit(units)).cast("int").alias("unit")))
    placed = join_unique(edges, places.select(F.col("id").alias("src"), F.col("place").alias("s")), ["src"], rows)
    placed = join_unique(placed, places.select(F.col("id").alias("dst"), F.col("place").alias("d"), "unit"), ["dst"], rows)
    placed = placed.select("unit", "s", "d", F.coalesce("w", F.lit(0.0)).alias("w"))
    laid = places.select("unit", "place").repartition(units, "unit").groupBy("unit").cogroup(
        placed.repartition(units, "unit").groupBy("unit")).applyInPandas(_pack_unit, "unit int, at binary, upto binary, s binary, w binary")
    laid = settle(laid).repartition(units, "unit").persist(StorageLevel.MEMORY_AND_DISK)
    kind = dict(single.dtypes)["id"]
    schema = f"id {kind}, k double, own {kind}, w_own double, target {kind}, gain double, square double"

    def weigh(state: DataFrame) -> tuple[DataFrame, float, int]:
        known = state.filter(F.col("id").isNotNull()).select("id", F.coalesce("k", F.lit(0.0)).alias("k"), "label")
        parts = known.groupBy(F.pmod(F.xxhash64("id"), F.lit(units)).alias("part")).agg(*[F.collect_list(c).alias(c) for c in ("id", "k", "label")])
        sent = parts.select(F.explode(F.sequence(F.lit(0), F.lit(units - 1))).alias("unit"), "id", "k", "label").repartition(units, "unit")
        # The squares of the communities' weights, summed vertex by vertex; the figures are added up while the table is written.
        figures = Observation()
        picked = store(laid.groupBy("unit").cogroup(sent.groupBy("unit")).applyInPandas(_best_places(whole), schema).observe(
            figures, F.sum("w_own").alias("inside"), F.sum("square").alias("squares"), F.count_if(F.col("gain") > min_gain).alias("movers")).drop("square"))
        found = figures.get
        return picked, ((found["inside"] or 0.0) + inner) / whole - (found["squares"] or 0.0) / (whole * whole), found["movers"]

    return weigh, laid.unpersist


def _pack_unit(key: tuple, vertices: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
    """Places of a unit's vertices, where the edges of each end, and the edges' other ends and weights."""
    at = np.sort(vertices["place"].to_numpy(np.int32))
    local = np.searchsorted(at, edges["d"].to_numpy(np.int32))
    order = np.argsort(local, kind="stable")
    blobs = (at, np.cumsum(np.bincount(local, minlength=len(at))), edges["s"].to_numpy(np.int32)[order], edges["w"].to_numpy(np.float64)[order])
    return pd.DataFrame([(key[0], *[b.tobytes() for b in blobs])], columns=["unit", "at", "upto", "s", "w"])


def _weights_to(local: np.ndarray, group: np.ndarray, w: np.ndarray, vertices: int, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights from every vertex to every group it touches: vertices ascending, their groups ascending, sums."""
    cell = local * groups + group
    if vertices * groups <= 4 * len(cell):
        sums = np.bincount(cell, w, vertices * groups)
        cell = np.flatnonzero(sums)
        return cell // groups, cell % groups, sums[cell]
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    first = np.flatnonzero(np.diff(cell, prepend=-1))
    sums = np.add.reduceat(w[order], first) if len(first) else w
    return cell[first] // groups, cell[first] % groups, sums


def _weighed(at: np.ndarray, vertex: np.ndarray, s: np.ndarray, w: np.ndarray, k: np.ndarray, label: np.ndarray, whole: float) -> tuple[np.ndarray, ...]:
    """Of the vertices ``at``, whose edges are ``(vertex, s, w)``: weight to the own community, best community, gain of a move there, product of the own weight and the own community's."""
    names, group = np.unique(label, return_inverse=True)
    total = np.bincount(group, k)
    own, k = group[at], k[at]
    vertex, other, w_in = _weights_to(vertex, group[s], w, len(at), len(names))
    home = other == own[vertex]
    w_own = np.zeros(len(at))
    w_own[vertex[home]] = w_in[home]
    stay = w_own - (total[own] - k) * k / whole
    vertex, other = vertex[~home], other[~home]
    gain = w_in[~home] - total[other] * k[vertex] / whole
    # The highest gain, of equal ones the smallest name; groups are in the order of their names.
    best, target = stay.copy(), own.copy()
    np.maximum.at(best, vertex, gain)
    target[best > stay] = len(names)
    hit = gain == best[vertex]
    np.minimum.at(target, vertex[hit], other[hit])
    return w_own, names[target], 2.0 * (best - stay) / whole, k * total[own]


def _best_places(whole: float):
    def weigh(key: tuple, edges: pd.DataFrame, sent: pd.DataFrame) -> pd.DataFrame:
        columns = ["id", "k", "own", "w_own", "target", "gain", "square"]
        if not len(edges) or not len(sent):
            return pd.DataFrame(columns=columns)
        ids, k, label = (np.concatenate(sent[c].to_list()) for c in ("id", "k", "label"))
        order = np.argsort(ids)
        ids, k, label = ids[order], k[order], label[order]
        row = edges.iloc[0]
        at, upto, s, w = (np.frombuffer(row[c], t) for c, t in (("at", np.int32), ("upto", np.int64), ("s", np.int32), ("w", np.float64)))
        w_own, target, gain, square = _weighed(at, np.repeat(np.arange(len(at)), np.diff(upto, prepend=0)), s, w, k, label, whole)
        return pd.DataFrame(dict(zip(columns, (ids[at], k[at], label[at], w_own, target, gain, square))))
    return weigh


def _rounds_inside(whole: float, seed: str, min_gain: float, first_share: float, last_share: float):
    """The rounds of ``local_moves`` on the links ``(src, dst, w)`` of a whole graph; the last row has the values."""
    def rounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        links = pa.Table.from_batches(got).filter(pa.compute.is_valid(pa.compute.field("src"))) if got else None
        if not got or not links.num_rows:
            yield _rows([], [], [0.0])
            return
        w = links["w"].fill_null(0.0).to_numpy()
        ids, source = np.unique(links["src"].to_numpy(), return_inverse=True)
        k = np.bincount(source, w)
        ends = links["dst"].fill_null(0).to_numpy()
        target = np.minimum(np.searchsorted(ids, ends), len(ids) - 1)
        met = (ids[target] == ends) & links["dst"].is_valid().to_numpy()
        inner = w[met & (target == source)].sum()
        met &= target != source
        del links, got, ends
        source, target, w = source[met].astype(np.int32), target[met].astype(np.int32), w[met]
        order = np.argsort(target, kind="stable")
        source, target, w = source[order], target[order], w[order]
        every = np.arange(len(ids))

        def weigh(label: np.ndarray):
            w_own, best, gain, square = _weighed(every, target, source, w, k, label, whole)
            better = gain > min_gain
            return (label, best, gain, np.flatnonzero(better)), (w_own.sum() + inner) / whole - square.sum() / (whole * whole), int(better.sum())

        current, value, movers = weigh(every)
        values, share, turn = [value], first_share, 0
        while movers:
            apart = share < last_share or share * movers < 1
            label, best, _, better = current
            draws = [f"{v}#{turn}#{seed}".encode() for v in ids[better].tolist()]
            if apart:
                moving = _apart_inside(label[better], best[better], better, np.array([_xxhash64(d) for d in draws], np.int64))
            else:
                moving = better[np.array([int(md5(d).hexdigest()[:8], 16) / 4294967296.0 for d in draws]) < share]
            trial = label.copy()
            trial[moving] = best[moving]
            trial, after, left = weigh(trial)
            turn += 1
            if after > value:
                current, value, movers = trial, after, left
                values.append(value)
                share = min(first_share, max(2 * share, last_share))
            elif apart:
                break  # what is left to gain is lost in rounding
            else:
                share /= 8
        yield _rows(ids, ids[current[0]], values)
    return rounds


def _rows(ids, labels, values: list[float]) -> pa.RecordBatch:
    n = len(ids)
    columns = [pa.array([*map(int, x), None], pa.int64()) for x in (ids, labels)]
    return pa.RecordBatch.from_arrays([*columns, pa.array([*[None] * n, [float(v) for v in values]], pa.list_(pa.float64()))], names=["id", "label", "values"])


def _apart_inside(own: np.ndarray, target: np.ndarray, vertex: np.ndarray, place: np.ndarray) -> np.ndarray:
    """``_apart`` of some vertices."""
    community, claim = np.concatenate([own, target]), np.tile(np.arange(len(vertex)), 2)
    order = np.lexsort((vertex[claim], place[claim], community))
    last = np.flatnonzero(np.append(np.diff(community[order]) != 0, True))
    return vertex[np.bincount(claim[order[last]], minlength=len(vertex)) == 2]


_P = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
_WORD = (1 << 64) - 1


def _xxhash64(text: bytes, seed: int = 42) -> int:
    """What Spark's ``xxhash64`` gives for a string."""
    def turned(x: int, by: int) -> int:
        return (x << by | x >> 64 - by) & _WORD

    def mixed(x: int, word: int) -> int:
        return turned((x + word * _P[1]) & _WORD, 31) * _P[0] & _WORD

    at, size = 0, len(text)
    if size >= 32:
        v = [(seed + _P[0] + _P[1]) & _WORD, (seed + _P[1]) & _WORD, seed, (seed - _P[0]) & _WORD]
        while at <= size - 32:
            v = [mixed(x, int.from_bytes(text[at + 8 * i:at + 8 * i + 8], "little")) for i, x in enumerate(v)]
            at += 32
        h = sum(turned(x, by) for x, by in zip(v, (1, 7, 12, 18))) & _WORD
        for x in v:
            h = ((h ^ mixed(0, x)) * _P[0] + _P[3]) & _WORD
    else:
        h = (seed + _P[4]) & _WORD
    h = (h + size) & _WORD
    while at <= size - 8:
        h = (turned(h ^ mixed(0, int.from_bytes(text[at:at + 8], "little")), 27) * _P[0] + _P[3]) & _WORD
        at += 8
    if at <= size - 4:
        h = (turned(h ^ int.from_bytes(text[at:at + 4], "little") * _P[0] & _WORD, 23) * _P[1] + _P[2]) & _WORD
        at += 4
    for byte in text[at:]:
        h = turned(h ^ byte * _P[4] & _WORD, 11) * _P[0] & _WORD
    h = (h ^ h >> 33) * _P[1] & _WORD
    h = (h ^ h >> 29) * _P[2] & _WORD
    h ^= h >> 32
    return h - (1 << 64) if h >> 63 else h


def _apart(movers: DataFrame) -> DataFrame:
    """Ids of movers ``(id, own, target, place)`` that are first, by place, in the community they leave and in the one they enter."""
    claims = movers.select("id", "place", F.explode(F.array("own", "target")).alias("community"))
    first = claims.groupBy("community").agg(F.max(F.struct("place", "id")).alias("first"))
    return first.groupBy(F.col("first.id").alias("id")).agg(F.count("*").alias("n")).filter(F.col("n") == 2).select("id")


def community_summary(groups: DataFrame, scores: DataFrame, names: DataFrame, shown: int = 5) -> DataFrame:
    """Per community: id by size, size, share of all vertices, first members by id, mean PageRank.

    The members shown come from a per-group top-k (cut before the shuffle), never from collecting a
    whole community.
    """
    sizes = groups.join(scores, "id", "left").groupBy("label").agg(
        F.count("*").alias("size"), F.avg(F.coalesce("pagerank", F.lit(0.0))).alias("avg_pagerank")
    )
    ranked = global_rank(sizes, [F.desc("size"), F.asc("label")], "community")
    first = F.row_number().over(Window.partitionBy("label").orderBy("id"))
    heads = (
        groups.withColumn("_n", first).filter(F.col("_n") <= shown).join(names.select("id", "name"), "id", "left")
        .groupBy("label").agg(F.array_sort(F.collect_list(F.struct("_n", "name"))).alias("_heads"))
        .select("label", F.array_join(F.transform("_heads", lambda h: h["name"]), "; ").alias("top_members"))
    )
    whole = groups.agg(F.count("*")).scalar().cast("double")
    return ranked.join(heads, "label").select(
        (F.col("community") - 1).alias("community"), "label", "size",
        (100.0 * F.col("size") / whole).alias("share_pct"), "top_members", "avg_pagerank",
    )


def group_sizes_scalar(groups: DataFrame, column: str):
    """Number of distinct groups, as a scalar subquery."""
    return groups.agg(F.count_distinct(column)).scalar()


def numbered(groups: DataFrame) -> DataFrame:
    """``(id, label, community)`` with communities numbered from 0 by size."""
    sizes = groups.groupBy("label").agg(F.count("*").alias("size"))
    ranked = global_rank(sizes, [F.desc("size"), F.asc("label")], "community")
    return join_unique(groups, ranked.select("label", (F.col("community") - 1).alias("community")), ["label"])
