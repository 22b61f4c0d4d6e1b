"""Near-duplicate documents by min-max hashing, confirmed on full shingle sets.

Every permutation gives two signature values, the smallest and the largest hash of a document's shingles, so ``PERMUTATIONS`` hash
evaluations give twice as many values. ``ROWS`` values form a band; documents that share a band are candidates. Two
documents at the threshold share none of the bands with a probability of about 1e-5, if their sets are large. In small sets minimum and maximum depend on each other, which
makes it up to 2e-4 with these bands; sets of at most ``SHORT`` shingles therefore have twice as many permutations, which makes it less than 1e-7.

Documents with the same shingle set form one class, and only classes are compared. In a bucket (one band value) every
class is first compared with the bucket's hub; classes linked by then need no further comparison with each other. Classes
of buckets that still hold several components are joined exactly, by prefix, length and positional filters on their shingles, so no
link between components is missed. A group of near copies thus costs comparisons in proportion to its size, not to its
square. Sets are only made for classes in shared buckets.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowatlas.llm.common import SPACED, column, hashed_words, map_arrow, mix, read_table, slices, written
from flowatlas.llm.linking import components

SHINGLE, PERMUTATIONS, ROWS, SHORT = 5, 64, 4, 32
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Up to so many document ids are sent to all workers to pick their texts; more are joined.
BROADCAST_IDS = 500_000
BATCH_CHARS = 1_000_000

_FITS = f"100 * least(size, n_shingles) >= {PERCENT} * greatest(size, n_shingles)"
_RANDOM = np.random.Generator(np.random.PCG64(7))
_PLACE = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_FACTOR = _RANDOM.integers(1, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _RANDOM.integers(0, 2**63, 4096, dtype=np.uint64)


def shingle_sets(texts: list, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's word shingles; of the whole sequence if it is shorter."""
    words, bounds = hashed_words(texts, SPACED)
    n = len(words)
    rolled = np.zeros(max(n - size + 1, 0), np.uint64)
    for k in range(size if n >= size else 0):
        rolled += words[k:n - size + 1 + k] * _PLACE[k]
    rolled = mix(rolled)
    sets = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= size:
            sets.append(np.unique(rolled[a:b - size + 1]))
        elif b > a:
            sets.append(mix((words[a:b] * _PLACE[:b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
        else:
            sets.append(words[:0])
    return sets


def band_keys(sets: list[np.ndarray], permutations: int = PERMUTATIONS, rows: int = ROWS) -> np.ndarray:
    """One key per band for each non-empty set, from the minimum and maximum under every permutation."""
    bounds = np.cumsum([0, *map(len, sets)])[:-1]
    flat = np.concatenate(sets)
    values = np.empty((2 * permutations, len(sets)), np.uint64)
    for p in range(permutations):
        hashed = (flat ^ _SHIFT[p]) * _FACTOR[p]
        values[2 * p] = np.minimum.reduceat(hashed, bounds)
        values[2 * p + 1] = np.maximum.reduceat(hashed, bounds)
    bands = 2 * permutations // rows
    keys = np.empty((len(sets), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(sets), b, np.uint64)
        for r in range(rows):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + values[b * rows + r])
        keys[:, b] = key
    return keys


def _features(batches):
    for batch in batches:
        texts = column(batch, "text")
        for a, b in slices(texts, BATCH_CHARS):
            sets = shingle_sets(texts[a:b])
            bands: list = [[]] * len(sets)
            # The first bands are the same for all sets, so short and long ones meet in them.
            for times, some in ((2, [k for k, s in enumerate(sets) if 0 < len(s) <= SHORT]), (1, [k for k, s in enumerate(sets) if len(s) > SHORT])):
                keys = band_keys([sets[k] for k in some], times * PERMUTATIONS).view(np.int64) if some else np.zeros((0, 0), np.int64)
                for k, row in zip(some, keys.tolist()):
                    bands[k] = row
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "digest", "bands"])


def _sets(batches):
    for batch in batches:
        texts = column(batch, "text")
        for a, b in slices(texts, BATCH_CHARS):
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([s.tobytes() for s in shingle_sets(texts[a:b])], pa.binary())],
                                             names=["rep", "shingles"])


def _similar(batches):
    for batch in batches:
        left, right = batch.column(2), batch.column(3)
        keep = []
        for k in range(len(left)):
            x, y = np.frombuffer(left[k].as_buffer(), np.uint64), np.frombuffer(right[k].as_buffer(), np.uint64)
            at = np.searchsorted(y, x)
            common = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(x) and len(y) else 0
            keep.append(common > 0 and 100 * common >= PERCENT * (len(x) + len(y) - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _shingle_rows(batches):
    for batch in batches:
        for rep, raw in zip(column(batch, "rep"), batch.column(1)):
            found = np.frombuffer(raw.as_buffer(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), rep)), pa.array(found)], names=["rep", "shingle"])


def _sets_of(reps: DataFrame, docs: DataFrame) -> DataFrame:
    """Shingle sets of the documents ``reps(rep)``, as a table."""
    ids = written(reps.select(F.col("rep").alias("of")).distinct())
    chosen = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    rows = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
    return written(map_arrow(rows.join(chosen, F.col("rep") == F.col("of"), "left_semi"), _sets, "rep long, shingles binary"))


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose full shingle sets are similar enough."""
    rows = written(pairs).join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("right")), "b") \
        .join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("left")), "a")
    return written(map_arrow(rows.select("a", "b", "left", "right"), _similar, "a long, b long").distinct())


def _mixed(placed: DataFrame) -> DataFrame:
    """``(rep, n_shingles, component)`` of the classes in buckets that hold more than one component."""
    keys = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("key")
    return written(placed.join(written(keys), "key").select("rep", "n_shingles", "component").distinct())


def _prefix_pairs(open_: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of different components that can reach the threshold, by exact prefix filtering.

    With the shingles of every class in one order, rarest first, a pair that has ``need`` shingles in common meets on one that has
    no more than ``size - need`` others before it on either side. Shingles of one class alone take up such places without meeting anything.
    """
    rows = map_arrow(sets.join(open_.select("rep"), "rep", "left_semi"), _shingle_rows, "rep long, shingle long")
    common = written(rows.groupBy("shingle").agg(F.count("*").alias("n")).filter("n > 1"))
    ordered = rows.join(common, "shingle", "left").groupBy("rep").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "shingle"))).alias("found"))
    first = ordered.join(open_, "rep").select(
        "rep", "n_shingles", "component", F.posexplode(F.slice("found", F.lit(1), F.expr(f"int(n_shingles - ceil({PERCENT} * n_shingles / 100) + 1)"))).alias("place", "token"))
    first = written(first.filter("token.n > 1").select("rep", "n_shingles", "component", "place", F.col("token.shingle").alias("shingle")))
    other = first.select("shingle", F.col("rep").alias("b"), F.col("n_shingles").alias("size"), F.col("component").alias("of"), F.col("place").alias("at"))
    need = f"ceil({PERCENT} * (n_shingles + size) / {100 + PERCENT})"
    return first.join(other, "shingle").filter("component < of").filter(_FITS) \
        .filter(f"place <= n_shingles - {need} AND at <= size - {need}") \
        .select(F.least("rep", "b").alias("a"), F.greatest("rep", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs(doc_id, text)``.

    Null and empty texts have no shingles and are linked with nothing. Rows with a null id are never named and not
    linked: their component is their own null id. Rows that repeat an id share its component.
    """
    features = written(map_arrow(
        docs.select(F.col("doc_id").cast("long"), "text"), _features, "doc_id long, n_shingles long, digest binary, bands array<long>"))
    known = features.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = written(known.groupBy("digest", "n_shingles", "bands").agg(F.min("doc_id").alias("rep")))
    entries = classes.select("rep", "n_shingles", F.explode("bands").alias("key"))
    sizes = written(entries.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"))
    shared = written(entries.join(sizes, "key"))
    # The hub of a bucket is the class with most neighbours in all its buckets: in a group of copies, the text nearest to all.
    weights = written(shared.groupBy("rep").agg(F.sum("n").alias("weight")))
    shared = written(shared.join(weights, "rep"))
    hubs = written(shared.groupBy("key").agg(F.max(F.struct("weight", (-F.col("rep")).alias("rep"), "n_shingles")).alias("hub"))
                   .select("key", (-F.col("hub.rep")).alias("hub"), F.col("hub.n_shingles").alias("size")))
    shared = written(shared.drop("weight", "n").join(hubs, "key"))
    sets = _sets_of(shared, docs)
    ends = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    pairs = shared.filter("rep <> hub").filter(_FITS).select(F.col("hub").alias("a"), F.col("rep").alias("b")).select(*ends).distinct()
    links = _linked(pairs, sets)
    labels = written(components(links))
    placed = shared.drop("size").join(labels.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    rest = _prefix_pairs(_mixed(placed), sets)
    more = _linked(rest, sets)
    if not more.isEmpty():
        labels = written(components(links.unionByName(more)))
    named = written(classes.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("class")))
    return features.join(named, "digest", "left").select(
        "doc_id", "n_shingles",
        F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("class")).otherwise(F.col("doc_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id; of rows equal in id and text one.

    Rows without an id stay. Only the ids of dropped documents meet the texts.
    """
    verdicts = written(near_duplicates(docs.select("doc_id", "text")).select(F.col("doc_id").alias("of"), "kept"))
    dropped = verdicts.filter("NOT kept").select("of").distinct()
    repeated = written(verdicts.filter("kept AND of IS NOT NULL").groupBy("of").agg(F.count("*").alias("n")).filter("n > 1").select("of"))
    dropped = F.broadcast(dropped) if dropped.count() <= BROADCAST_IDS else dropped
    # Packed, so that no column of docs can clash with the ids.
    rows = docs.select(F.col("doc_id").cast("long").alias("of"), "text", F.struct(*docs.columns).alias("row")).join(dropped, "of", "left_anti")
    if not repeated.isEmpty():
        rows = rows.join(repeated, "of", "left_anti").unionByName(rows.join(repeated, "of", "left_semi").dropDuplicates(["of", "text"]))
    return rows.select("row.*")


def op7_minhash(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))
