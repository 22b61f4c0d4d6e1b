"""Vector codes by product quantisation, with nearest entries found by pivots (LAESA).

Vectors become integers and are cut into equal parts; every part position has a codebook, and a vector is kept as the numbers of its parts' nearest
entries. Distances between the parts and a few fixed pivots of their position are computed once and written next to the vectors. In every round
the distances between pivots and entries give, by the triangle inequality, a lower bound of the distance between a part and an entry: entries are
tried in the order of their bounds, and those whose bound exceeds the best distance found are never evaluated. Evaluations are exact, in integers; the bounds
are in double precision, taken a little lower, so that no nearest entry and no tie is lost.

A round moves no vectors: each task sends sums of its parts per entry, of which there are (positions x entries) at most. Codebooks and pivots are as
small and go through the driver.

Rows whose vector is null or empty or holds null or non-finite components are left out, and so are vectors of another length than that of the
smallest remaining id (of its smallest vector in the order of its components, where rows repeat the id). Rows with a null id are coded like others, and come after them in
the order in which entries start. Repeated rows are rows of their own. With fewer rows than entries, the codebooks have as many entries as there are rows; an
empty table gives no rows. A vector length that is no multiple of the number of parts, and components so large that squared
distances do not fit into 64 bits, raise an error.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowatlas.llm.common import map_arrow, read_table, without, written
from flowatlas.operators.skew import join_unique

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Fixed pivots per part position; parts whose bounds are held at once.
PIVOTS, BLOCK = 4, 4_096


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector has components, all of them finite numbers."""
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return rows.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad)


def integers(rows: DataFrame, vector: str, scale: int = SCALE) -> DataFrame:
    """``(vec_id, label, v)``: the rows that count, components as integers ``floor(scale * x)``."""
    label = F.col("label").cast("string") if "label" in rows.columns else F.lit(None).cast("string")
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return usable(rows, vector).select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), whole.alias("v"))


def _matrix(batch: pa.RecordBatch, name: str, kind) -> np.ndarray:
    lists = batch.column(batch.schema.get_field_index(name))
    return lists.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(lists), -1)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors, along the last axis."""
    d = x - y
    return (d * d).sum(axis=-1)


def choose_pivots(entries: np.ndarray, count: int) -> np.ndarray:
    """``count`` far-apart vectors of (entries, width): each the one whose smallest distance to those chosen is largest."""
    chosen = [0]
    nearest = squared(entries, entries[0])
    while len(chosen) < min(count, len(entries)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(entries, entries[chosen[-1]]))
    return entries[chosen]


def nearest_entries(x: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest entry, squared distance) of each row of ``x``, ties to the smaller number; and how many distances were evaluated.

    ``to_pivots`` holds the distances between the rows and ``pivots``.
    """
    from_pivots = np.sqrt(squared(pivots[:, None, :], entries[None, :, :]).astype(np.float64))
    best = np.empty(len(x), np.int64)
    distance = np.empty(len(x), np.int64)
    evaluated = 0
    for s in range(0, len(x), BLOCK):
        part, own = x[s:s + BLOCK], to_pivots[s:s + BLOCK]
        bound = np.zeros((len(part), len(entries)))
        for p in range(len(pivots)):
            np.maximum(bound, np.abs(own[:, p, None] - from_pivots[p]), out=bound)
        # Rounding of the square roots never makes a bound too large.
        bound = np.maximum(bound * (1 - 1e-12) - 1e-6, 0.0)
        bound *= bound
        least = np.full(len(part), np.iinfo(np.int64).max)
        number = np.full(len(part), len(entries))
        active = np.arange(len(part))
        while len(active):
            tried = bound[active].argmin(axis=1)
            active_bound = bound[active, tried]
            going = active_bound <= least[active]
            active, tried = active[going], tried[going]
            if not len(active):
                break
            found = squared(part[active], entries[tried])
            evaluated += len(active)
            bound[active, tried] = np.inf
            closer = (found < least[active]) | ((found == least[active]) & (tried < number[active]))
            least[active[closer]], number[active[closer]] = found[closer], tried[closer]
        best[s:s + BLOCK], distance[s:s + BLOCK] = number, least
    return best, distance, evaluated


class Codebooks:
    """Entries (positions, entries, width) and fixed pivots (positions, pivots, width), both of integers."""

    def __init__(self, entries: np.ndarray, pivots: np.ndarray):
        self.entries, self.pivots = entries, pivots

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _with_pivots(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``rows`` with ``to_pivots``, the distances between each part and the pivots of its position."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)
    kept = without(rows.columns, "to_pivots")

    def run(batches):
        p = shared.value
        for batch in batches:
            x = _matrix(batch, "v", np.int64)
            top = int(np.abs(x).max(initial=0)) + int(np.abs(p).max())
            if x.shape[0] and p.shape[2] * top * top >= 1 << 62:
                raise ValueError(f"components of {top} are too large for exact squared distances")
            parts = x.reshape(len(x), p.shape[0], 1, p.shape[2])
            far = np.sqrt(squared(parts, p[None]).astype(np.float64)).reshape(len(x), -1)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(far.ravel()), far.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "to_pivots"])

    schema = ", ".join([*(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in kept), "to_pivots array<double>"])
    return map_arrow(rows.select(*kept), run, schema)


def _assigned(batch: pa.RecordBatch, books: Codebooks):
    """Integers (rows, positions, width), nearest entries (rows, positions), squared distances, evaluations."""
    positions, _, width = books.entries.shape
    x = _matrix(batch, "v", np.int64).reshape(-1, positions, width)
    far = _matrix(batch, "to_pivots", np.float64).reshape(len(x), positions, -1)
    numbers, errors = np.zeros(x.shape[:2], np.int64), np.zeros(x.shape[:2], np.int64)
    evaluated = 0
    for p in range(positions):
        numbers[:, p], errors[:, p], n = nearest_entries(x[:, p], far[:, p], books.entries[p], books.pivots[p])
        evaluated += n
    return x, numbers, errors, evaluated


def _updated(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Entries replaced by the rounded-down means of the parts nearest to them."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    positions, entries, width = books.entries.shape

    def run(batches):
        counts = np.zeros(positions * entries, np.int64)
        sums = np.zeros((positions * entries, width), np.int64)
        for batch in batches:
            x, numbers, _, _ = _assigned(batch, shared.value)
            slot = (numbers + np.arange(positions) * entries).ravel()
            counts += np.bincount(slot, minlength=len(counts))
            np.add.at(sums, slot, x.reshape(-1, width))
        used = np.flatnonzero(counts)
        lists = pa.FixedSizeListArray.from_arrays(pa.array(sums[used].ravel()), width).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used]), lists], names=["slot", "n", "sums"])

    parts = map_arrow(rows.select("v", "to_pivots"), run, "slot long, n long, sums array<long>")
    # Sums of 64-bit integers over all rows may need more: they are added as decimals.
    total = parts.groupBy("slot").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(width)])
    new = books.entries.reshape(-1, width).copy()
    for row in total.collect():  # at most one row per entry
        new[row["slot"]] = [int(row[f"s{k}"]) // row["n"] for k in range(width)]
    return Codebooks(new.reshape(books.entries.shape), books.pivots)


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks | None]:
    """Rows of the common length with their pivot distances, as a table, and the codebooks; None for an empty table."""
    start = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(1).collect()
    if not start:
        return rows, None
    length = len(start[0]["v"])
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    same = rows.filter(F.size("v") == length)
    first = np.array([r["v"] for r in same.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()], np.int64)
    book = first.reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    pivots = np.stack([choose_pivots(b, PIVOTS) for b in book])
    placed = written(_with_pivots(same, pivots))
    books = Codebooks(book, pivots)
    for _ in range(rounds):
        books = _updated(placed, books)
    return placed, books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``rows`` (with ``v`` and ``to_pivots``) with ``code`` (a byte per part), ``error`` and the number of distances ``evaluated``."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    kept = without(rows.columns, "v", "to_pivots", "code", "error", "evaluated")
    width = (books.entries.shape[1] - 1).bit_length() + 7 >> 3 or 1

    def run(batches):
        for batch in batches:
            _, numbers, errors, n = _assigned(batch, shared.value)
            raw = numbers.astype(f">u{1 if width == 1 else 2 if width == 2 else 8}").tobytes()
            size = len(raw) // len(batch) if len(batch) else 1
            codes = pa.array([raw[k * size:(k + 1) * size] for k in range(len(batch))], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(k)) for k in kept), codes, pa.array(errors.sum(axis=1)),
                                              pa.array(np.full(len(batch), n / max(len(batch), 1)))], names=[*kept, "code", "error", "evaluated"])

    schema = ", ".join([*(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in kept), "code binary, error long, evaluated double"])
    return map_arrow(rows, run, schema)


def compressed(rows: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)`` for every row of ``rows`` that counts."""
    placed, books = train(written(integers(rows, vector)), parts, entries, rounds)
    if books is None:
        return placed.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"),
                             F.lit("").alias("codebooks_sha256"))
    coded = written(encode(placed, books)).withColumns({"no_label": F.col("label").isNull(), "label": F.coalesce("label", F.lit(""))})
    sums = coded.groupBy("no_label", "label").agg(F.sum("error").alias("label_error"))
    return join_unique(coded, sums, ["no_label", "label"]).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def _oracle() -> str:
    """Brute force over all entries, a round per CTE."""
    width = 4
    ctes = ["""good AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
            f"parts AS MATERIALIZED (SELECT r, p, v[p * {width} + 1:p * {width} + {width}] AS x FROM good, (SELECT unnest(range(16)) AS p))",
            "book_0 AS MATERIALIZED (SELECT p, r - 1 AS k, x AS e FROM parts WHERE r <= 64)"]
    gap = " + ".join(f"(x[{j}] - e[{j}]) * (x[{j}] - e[{j}])" for j in range(1, width + 1))
    for n in range(3):
        ctes.append(f"""near_{n} AS MATERIALIZED (SELECT r, p, any_value(x) AS x, min((d, k)) AS best FROM (
          SELECT r, a.p, x, k, {gap} AS d FROM parts a JOIN book_{n} b ON a.p = b.p) GROUP BY r, p)""")
        if n < 2:
            means = ", ".join(f"CAST((sum(x[{j}]) - (((sum(x[{j}]) % count(*)) + count(*)) % count(*))) // count(*) AS BIGINT)" for j in range(1, width + 1))
            ctes.append(f"""book_{n + 1} AS MATERIALIZED (SELECT b.p, b.k, coalesce(m.e, b.e) AS e FROM book_{n} b LEFT JOIN (
              SELECT p, best[2] AS k, [{means}] AS e FROM near_{n} GROUP BY p, best[2]) m ON b.p = m.p AND b.k = m.k)""")
    ctes.append("""coded AS MATERIALIZED (SELECT r, string_agg(lpad(to_hex(best[2]), 2, '0'), '' ORDER BY p) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM near_2 GROUP BY r)""")
    return "WITH " + ",\n".join(ctes) + """
SELECT vec_id, lower(code) AS code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY p, k)) FROM book_2) AS codebooks_sha256
FROM good JOIN coded ON good.r = coded.r"""


ORACLE = _oracle()


def op12_codes(spark, sf_dir: str) -> DataFrame:
    """Codes of all vectors."""
    return compressed(read_table(spark, sf_dir, "embeddings"))
