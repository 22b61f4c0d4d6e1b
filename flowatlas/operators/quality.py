"""Input gate: which columns are missing and which rows break the basic rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowatlas.sources.trips import DURATION, REQUIRED


def quality_report(df: DataFrame) -> DataFrame:
    """One row: status, missing columns, warnings and the counts behind them (one scan)."""
    missing = [c for c in REQUIRED if c not in df.columns]
    derivable = DURATION in missing and {"pickup_datetime", "dropoff_datetime"} <= set(df.columns)
    errors = [c for c in missing if not (c == DURATION and derivable)]
    warnings = ["duration_derived"] if derivable else []
    if errors:
        schema = "status string, errors string, warnings string, total_rows long, unique_pu long, unique_do long, " \
                 "zero_distance long, zero_distance_pct double, zero_duration long, zero_duration_pct double"
        row = ("FAIL", ",".join(errors), ",".join(warnings), *[None] * 7)
        return df.sparkSession.createDataFrame([row], schema)
    duration_bad = F.count_if(F.col(DURATION) <= 0) if DURATION in df.columns else F.lit(0).cast("long")
    # Counted per pair of zones first: distinct ends next to plain counts would make Spark copy every trip three times.
    pairs = df.groupBy("PULocationID", "DOLocationID").agg(
        F.count("*").alias("rows"), F.count_if(F.col("trip_distance") <= 0).alias("no_distance"), duration_bad.alias("no_duration"))
    counts = pairs.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("no_distance"), F.lit(0)).alias("zero_distance"),
        F.coalesce(F.sum("no_duration"), F.lit(0)).cast("long").alias("zero_duration"),
        F.count_distinct("PULocationID").alias("unique_pu"),
        F.count_distinct("DOLocationID").alias("unique_do"),
    )
    total = F.nullif(F.col("total_rows"), F.lit(0))
    return counts.select(
        F.lit("OK").alias("status"),
        F.lit("").alias("errors"),
        F.concat_ws(
            ",", *[F.lit(w) for w in warnings],
            F.when(F.col("zero_distance") > 0, "zero_distance"),
            F.when(F.col("zero_duration") > 0, "zero_duration"),
        ).alias("warnings"),
        "total_rows", "unique_pu", "unique_do", "zero_distance",
        (100.0 * F.col("zero_distance") / total).alias("zero_distance_pct"),
        "zero_duration",
        (100.0 * F.col("zero_duration") / total).alias("zero_duration_pct"),
    )
