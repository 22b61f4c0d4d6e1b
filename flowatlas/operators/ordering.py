"""Global ranks and running totals without a single-task window.

``Window.orderBy`` without ``partitionBy`` moves all rows to one task. Here rows are range
partitioned, settled, summed per partition (one row per partition), and every row adds the
total of the partitions before its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowatlas.session import settle


def running_total(df: DataFrame, order: list[Column], value: Column, name: str) -> DataFrame:
    """Add ``name`` = inclusive running sum of ``value`` in the given total order."""
    ranged = df.withColumn("_value", value).repartitionByRange(*order)
    # The partition number is written with the rows: a re-run could sample other bounds.
    placed = settle(ranged.withColumn("_slice", F.spark_partition_id()))
    totals = placed.groupBy("_slice").agg(F.sum("_value").alias("_total"))
    before = totals.select(
        "_slice",
        F.coalesce(
            F.sum("_total").over(Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_before"),
    )
    inside = Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.withColumn("_inside", F.sum("_value").over(inside))
        .join(before, "_slice")  # one row per partition of the sort
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_value", "_slice", "_inside", "_before")
    )


def following(df: DataFrame, group: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Add ``name`` = ``value`` of the next row of the same ``group`` in the given order, null at the group's end.

    Groups are not brought together: rows are range partitioned by group and order, so a group that holds a third of all
    rows spreads over many partitions, and the last row of a partition looks at the first row of the next one that has any.
    """
    row = F.struct(*[F.col(c).alias(f"g{k}") for k, c in enumerate(group)], *[F.col(c).alias(f"o{k}") for k, c in enumerate(order)],
                   F.col(value).alias("value"))
    placed = settle(df.repartitionByRange(*group, *order).withColumn("_slice", F.spark_partition_id()))
    # One row per partition of the sort.
    firsts = settle(placed.groupBy("_slice").agg(F.min(row).alias("_first")))
    carried = firsts.select("_slice", F.lead("_first").over(Window.orderBy("_slice")).alias("_carry"))
    slices = max(1, firsts.count())
    inside = Window.partitionBy("_slice").orderBy(*group, *order, value)
    # A slice to each task: by hash some tasks would get several.
    found = placed.repartitionByRange(slices, "_slice").withColumns({
        "_more": F.lead(F.lit(True)).over(inside), "_next": F.lead(value).over(inside), **{f"_g{k}": F.lead(c).over(inside) for k, c in enumerate(group)}})
    same = reduce(Column.__and__, [F.when(F.col("_more"), F.col(f"_g{k}").eqNullSafe(F.col(c))).otherwise(F.col("_carry").isNotNull() & F.col(f"_carry.g{k}").eqNullSafe(F.col(c)))
                                   for k, c in enumerate(group)])
    return (
        found.join(F.broadcast(carried), "_slice")
        .withColumn(name, F.when(same, F.when(F.col("_more"), F.col("_next")).otherwise(F.col("_carry.value"))))
        .drop("_slice", "_carry", "_more", "_next", *[f"_g{k}" for k in range(len(group))])
    )


def global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``row_number`` over the whole relation; ``order`` must be a total order."""
    return running_total(df, order, F.lit(1).cast("long"), name).withColumn(name, F.col(name).cast("int"))


def top(df: DataFrame, order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """First ``k`` rows with their position; the window only ever sees those ``k`` rows."""
    first = df.orderBy(*order).limit(k)
    return first.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def exact_median(df: DataFrame, column: str) -> DataFrame:
    """One row ``median``: mean of the two middle values, found on (value, count) rows."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("c"))
    ranked = settle(running_total(counts, [F.col("v")], F.col("c"), "upto"))
    n = ranked.agg(F.max("upto").alias("n")).scalar()
    lower, upper = F.floor((n + 1) / 2), F.ceil((n + 1) / 2)
    begins = F.col("upto") - F.col("c")
    middle = ranked.filter((begins < upper) & (F.col("upto") >= lower))
    return middle.agg(((F.min("v") + F.max("v")) / F.lit(2.0)).alias("median"))
