"""Trip cleaning rules, origin-destination aggregation and the reports on both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_DURATION_MINUTES = 300
MIN_LOOP_DISTANCE = 0.1
MIN_TRIPS = 50

_C = F.col


def positive(name: str) -> Column:
    """Above zero and a number: Spark counts NaN as larger than anything."""
    return (_C(name) > 0) & ~F.isnan(name)


def rules(profile: str = "base") -> Column:
    """Predicate of rows to keep. ``strict`` also asks for a fare and a passenger."""
    keep = (
        positive("trip_distance")
        & positive("trip_duration_minutes")
        & (_C("trip_duration_minutes") <= MAX_DURATION_MINUTES)
        & ~((_C("PULocationID") == _C("DOLocationID")) & (_C("trip_distance") < MIN_LOOP_DISTANCE))
    )
    if profile == "base":
        return keep
    if profile == "strict":
        return keep & positive("fare_amount") & (_C("passenger_count") > 0)
    raise ValueError(f"unknown profile {profile!r}; use 'base' or 'strict'")


def clean(trips: DataFrame, profile: str = "base") -> DataFrame:
    return trips.filter(rules(profile))


def od_edges(trips: DataFrame, profile: str = "base", min_trips: int = MIN_TRIPS) -> DataFrame:
    """Directed edges between zones. Self-loops go before grouping, so they are never shuffled."""
    return (
        clean(trips, profile)
        .filter(_C("PULocationID") != _C("DOLocationID"))
        .groupBy(_C("PULocationID").alias("src"), _C("DOLocationID").alias("dst"))
        .agg(
            F.count("*").alias("weight"),
            F.avg("trip_duration_minutes").alias("avg_duration"),
            F.avg("trip_distance").alias("avg_distance"),
            F.sum("fare_amount").alias("total_fare"),
            F.avg("fare_amount").alias("avg_fare"),
        )
        .filter(_C("weight") >= min_trips)
    )


def cleaning_report(trips: DataFrame) -> DataFrame:
    """Raw, kept and removed rows per profile, in one pass over the trips."""
    counts = trips.agg(
        F.count("*").alias("raw"),
        F.count_if(rules("base")).alias("base"),
        F.count_if(rules("strict")).alias("strict"),
    )
    rows = counts.select(
        "raw",
        F.explode(F.array(*[
            F.struct(F.lit(p).alias("profile"), _C(p).alias("kept")) for p in ("base", "strict")
        ])).alias("r"),
    )
    removed = _C("raw") - _C("r.kept")
    return rows.select(
        "r.profile",
        _C("raw").alias("raw_rows"),
        _C("r.kept").alias("kept_rows"),
        removed.alias("removed_rows"),
        (100.0 * removed / F.nullif(_C("raw"), F.lit(0))).alias("removed_pct"),
    )


def pair_counts(trips: DataFrame, variants: dict[str, Column]) -> DataFrame:
    """Rows ``(variant, src, dst, n)``: one scan and one shuffle for all variants.

    The variants are counted side by side and only the per-pair counts are unpivoted.
    """
    wide = trips.groupBy(_C("PULocationID").alias("src"), _C("DOLocationID").alias("dst")).agg(
        *[F.count_if(keep).alias(name) for name, keep in variants.items()]
    )
    return wide.unpivot(["src", "dst"], list(variants), "variant", "n").filter(_C("n") > 0)


def _every(table: DataFrame, name: str, values: list) -> DataFrame:
    """``table`` with a row for each of the values; those it lacks have counts of 0."""
    rows = table.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, values))).alias(name))
    counts = [c for c in table.columns if c != name]
    return rows.join(table, name, "left").select(name, *[F.coalesce(c, F.lit(0).cast(table.schema[c].dataType)).alias(c) for c in counts])


def threshold_sweep(trips: DataFrame, thresholds: tuple[int, ...] = (40, 45, 50, 55, 60)) -> DataFrame:
    """Edges kept at each minimum trip count, without and with self-loops."""
    pairs = pair_counts(trips, {"base": rules("base")})
    levels = pairs.withColumn("min_trips", F.explode(F.array(*[F.lit(t) for t in thresholds])))
    kept = _C("n") >= _C("min_trips")
    return _every(levels.groupBy("min_trips").agg(
        F.count_if(kept & (_C("src") != _C("dst"))).alias("edges"),
        F.count_if(kept).alias("edges_with_loops"),
    ), "min_trips", list(thresholds))


def filter_ablation(trips: DataFrame, min_trips: int = MIN_TRIPS) -> DataFrame:
    """Rows, edges and flow under five rule sets."""
    base = rules("base")
    variants = {
        "distance": positive("trip_distance"),
        "distance_duration": positive("trip_distance") & positive("trip_duration_minutes"),
        "base": base,
        "base_fare": base & positive("fare_amount"),
        "base_passenger": base & (_C("passenger_count") > 0),
    }
    edge = (_C("src") != _C("dst")) & (_C("n") >= min_trips)
    return _every(pair_counts(trips, variants).groupBy("variant").agg(
        F.sum("n").alias("kept_rows"),
        F.count_if(edge).alias("edges"),
        F.coalesce(F.sum(F.when(edge, _C("n"))), F.lit(0)).cast("long").alias("flow"),
    ), "variant", list(variants))


def profile_comparison(trips: DataFrame, min_trips: int = MIN_TRIPS) -> DataFrame:
    """Graph size under both cleaning profiles side by side."""
    pairs = pair_counts(trips, {"base": rules("base"), "strict": rules("strict")})
    edges = pairs.filter((_C("src") != _C("dst")) & (_C("n") >= min_trips))
    ends = edges.select("variant", "n", F.posexplode(F.array("src", "dst")).alias("side", "id"))
    per_zone = ends.groupBy("variant", "id").agg(
        F.count_if(_C("side") == 0).alias("out_edges"), F.sum(F.when(_C("side") == 0, _C("n"))).alias("out_flow")
    )
    sizes = per_zone.groupBy(_C("variant").alias("profile")).agg(
        F.count("*").alias("nodes"), F.sum("out_edges").alias("edges"), F.sum("out_flow").cast("long").alias("flow")
    )
    return _every(sizes, "profile", ["base", "strict"]).withColumn("density", density(_C("nodes"), _C("edges")))


def density(nodes: Column, edges: Column) -> Column:
    return edges / F.nullif((nodes * (nodes - 1)).cast("double"), F.lit(0.0))


def monthly_counts(trips: DataFrame) -> DataFrame:
    month = F.date_format("pickup_datetime", "yyyy-MM")
    return trips.groupBy(month.alias("month")).agg(F.count("*").alias("trips"))


def zone_flow(trips: DataFrame) -> DataFrame:
    """Trips touching each zone, counted on raw rows as (inbound + outbound)."""
    ends = F.explode(F.array(
        F.struct(_C("DOLocationID").alias("id"), F.lit(True).alias("inbound")),
        F.struct(_C("PULocationID").alias("id"), F.lit(False).alias("inbound")),
    )).alias("e")
    # Pairs first: only they are doubled, not the trips.
    pairs = trips.groupBy("PULocationID", "DOLocationID").agg(F.count("trip_distance").alias("n"))
    return (
        pairs.select(ends, "n").filter(_C("e.id").isNotNull())
        .groupBy(_C("e.id").alias("id"))
        .agg(
            F.sum(F.when(_C("e.inbound"), _C("n")).otherwise(0)).alias("inbound"),
            F.sum(F.when(_C("e.inbound"), 0).otherwise(_C("n"))).alias("outbound"),
        )
        .withColumn("flow", _C("inbound") + _C("outbound"))
    )
