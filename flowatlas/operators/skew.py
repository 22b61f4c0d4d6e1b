"""Equi-join of a large relation, whose keys may be hot, with one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowatlas.session import store

BROADCAST_ROWS = 500_000
ROWS_PER_PART = 250_000
#: A broadcast passes through the driver, in loops once a round. Beyond this many rows it has to spare
#: the shuffle of a side that is ``WORTH`` times as large.
SMALL_ROWS = 5_000
WORTH = 50


def fits_task(rows: int) -> bool:
    """Whether one task should take all ``rows`` edges and vertices of a graph (some 100 MB): rounds of jobs cost more."""
    return rows <= min(800 * SMALL_ROWS, 8 * BROADCAST_ROWS)


def worth_broadcasting(rows: int, other: int) -> bool:
    """Whether a side of ``rows`` should be broadcast to one of ``other`` rows."""
    return rows <= BROADCAST_ROWS and (rows <= SMALL_ROWS or rows * WORTH <= other)


def join_unique(big: DataFrame, small: DataFrame, on: list[str], rows: int | None = None,
                how: str = "inner", big_rows: int | None = None) -> DataFrame:
    """Join ``big`` with ``small``, which has unique keys ``on``.

    ``small`` is broadcast when its count (or the bound ``rows``) allows; if the rows of ``big`` are known (``big_rows``), only
    where that pays. Otherwise keys with more
    than ``ROWS_PER_PART`` rows in ``big`` are split into parts and their single ``small`` row is copied
    to each part, so no task receives a whole hot key. AQE alone would not split such a join
    when ``small`` comes straight out of an aggregation on the same key.
    """
    if rows is None:
        small = store(small)
        rows = small.count()
    if rows <= BROADCAST_ROWS if big_rows is None else worth_broadcasting(rows, big_rows):
        return big.join(F.broadcast(small), on, how)
    big = store(big)
    counted = big.groupBy(*on).agg(F.count("*").alias("_n")).filter(F.col("_n") > ROWS_PER_PART)
    # At most one row per ROWS_PER_PART rows of ``big``.
    hot = store(counted.select(*on, F.ceil(F.col("_n") / ROWS_PER_PART).cast("int").alias("_parts")))
    if hot.count() <= BROADCAST_ROWS:
        hot = F.broadcast(hot)  # in practice a few rows, mostly none
    parts = F.coalesce("_parts", F.lit(1))
    others = [c for c in big.columns if c not in on] or on
    split = big.join(hot, on, "left").withColumn("_part", F.pmod(F.xxhash64(*others), parts).cast("int")).drop("_parts")
    copies = (
        small.join(hot, on, "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    )
    # Without the hint Spark would broadcast a table below its own limit after all.
    return split.join(copies.hint("shuffle_hash"), [*on, "_part"], how).drop("_part")
