"""Jobs whose rows, files or transfers must not grow faster than the tables."""

import os

import pytest
from pyspark.sql import functions as F

from flowatlas import session
from flowatlas.operators import community, components, paths, skew
from flowatlas.operators.adjacency import Adjacency
from flowatlas.plans import catalogue, fixtures as fx
from flowatlas.sources.trips import read_any


def test_hops_of_all_pairs_as_bits(spark, monkeypatch):
    """A wheel of more vertices than a block has sources, beside a copy with the hub gone in part; no table has a row per pair."""
    n, rows, real = 2_100, [], paths.settle
    monkeypatch.setattr(paths, "settle", lambda df: rows.append((out := real(df)).count()) or out)
    rim = spark.range(n).select(F.col("id").alias("src"), ((F.col("id") + 1) % n).alias("dst"))
    wheel = rim.unionByName(spark.range(n).select(F.lit(-1).cast("long").alias("src"), F.col("id").alias("dst")))
    star = spark.range(1, 5).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"))
    both = wheel.withColumn("step", F.lit(1)).unionByName(star.withColumn("step", F.lit(2)))
    expected = {1: (n + 1, (2 * n + 2 * n + 2 * n * (n - 3)) / ((n + 1) * n)), 2: (5, (4 * 2 + 4 * 3 * 2) / 20)}
    for limit in (10**9, 2_000_000):
        got = {r["step"]: r for r in paths.average_path_length(both, keys=("step",), rows_per_batch=limit).collect()}
        assert {k: (r["core_size"], r["avg_path"]) for k, r in got.items()} == {k: (v[0], pytest.approx(v[1])) for k, v in expected.items()}
    assert max(rows) < 10 * n


def test_removal_takes_all_edges(spark, tmp_path):
    """Where no edge has twice the mean moves, the removal queries still work on the whole graph."""
    folder = str(tmp_path)
    spark.range(6).select(F.col("id").alias("s_suppkey")).write.parquet(f"{folder}/supplier.parquet")
    spark.createDataFrame([(k, (k + 1) % 6) for k in range(6)], "l_suppkey long, l_partkey long").write.parquet(f"{folder}/lineitem.parquet")
    steps = {r["step"]: r["num_components"] for r in catalogue.QUERIES["removal_components"](spark, folder).collect()}
    assert steps[0] == 1 and len(steps) == 6
    timeline = {r["step"]: r["remaining_edges"] for r in catalogue.QUERIES["removal_timeline"](spark, folder).collect()}
    assert timeline[0] == 6 and timeline[1] == 4


def test_json_arrays_in_files_of_bounded_size(spark, tmp_path, monkeypatch):
    """Trips of one nation and quarter spread over several files; all are read again."""
    folder, lines = str(tmp_path), 200
    day = F.lit("1996-02-01").cast("timestamp_ntz")
    spark.range(lines).select(
        F.col("id").alias("l_orderkey"), F.col("id").alias("l_partkey"), F.lit(0).cast("long").alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
        (F.col("id") + 0.1).alias("l_quantity"), F.lit(0.5).alias("l_discount"), F.lit(10.0).alias("l_extendedprice"), F.lit(0.1).alias("l_tax"),
    ).write.parquet(f"{folder}/lineitem.parquet")
    spark.range(lines).select(F.col("id").alias("o_orderkey"), F.lit(0).cast("long").alias("o_custkey"), day.alias("o_orderdate")).write.parquet(f"{folder}/orders.parquet")
    spark.range(1).select(F.col("id").alias("c_custkey"), F.lit(1).alias("c_nationkey")).write.parquet(f"{folder}/customer.parquet")
    spark.range(1).select(F.col("id").alias("s_suppkey"), F.lit(2).alias("s_nationkey")).write.parquet(f"{folder}/supplier.parquet")
    monkeypatch.setattr(catalogue, "ARRAY_ROWS", 20)
    made = []
    real = catalogue.scratch_path
    monkeypatch.setattr(catalogue, "scratch_path", lambda *a: made.append(real(*a)) or made[-1])
    arrays = catalogue.QUERIES["source_json_array"](spark, folder).collect()
    files = [f for f in os.listdir(made[0]) if f.endswith(".txt")]
    assert 5 < len(files) <= 10
    assert arrays == catalogue.QUERIES["source_roundtrip_parquet"](spark, folder).collect() and arrays[0]["trips"] == lines


def test_json_numbers_keep_their_text_unless_told(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"fare": 1.10},\n{"fare": 25}]')
    def fares(**how):
        return sorted(r["fare"] for r in read_any(spark, str(tmp_path / "a.json"), **how).collect())
    assert fares() == ["1.10", "25"] and fares(exact=False) == ["1.1", "25"]


def test_sparse_graphs_are_not_broadcast(spark, monkeypatch):
    """A chain has no more edges than vertices: beyond a few, nothing of it is sent through the driver."""
    monkeypatch.setattr(skew, "SMALL_ROWS", 5)
    chain = spark.range(60).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"), F.lit(1).alias("weight"))
    links = Adjacency(chain, 61)
    pushed = links.push(spark.range(61).select("id", F.col("id").alias("label")))
    assert links.mode == "shuffle" and pushed.count() == 60
    assert {r["component"] for r in components.weak_components(chain).collect()} == {0}
    dense = spark.range(400).select((F.col("id") % 7).alias("src"), (F.col("id") % 11).alias("dst"))
    assert Adjacency(dense, 7).mode == "state"


def test_more_rows_get_more_tasks(spark, monkeypatch):
    """Label propagation holds about the same rows in a task at any size, and the session's settings come back."""
    monkeypatch.setattr(session, "ROWS_PER_TASK", 500)
    widths, real = [], community.settle
    key = "spark.sql.shuffle.partitions"
    monkeypatch.setattr(community, "settle", lambda df: widths.append(int(spark.conf.get(key))) or real(df))
    before = spark.conf.get(key), spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    edges = spark.range(3_000).select((F.col("id") % 60).alias("src"), F.floor(60 + F.col("id") / 60).alias("dst"))
    labels = community.label_propagation(edges, rounds=1)
    # 6,000 votes and 110 loops.
    assert labels.count() == 110 and widths[-1] == 12
    assert (spark.conf.get(key), spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")) == before


def test_merge_by_pattern_joins_the_trips_once(spark, monkeypatch):
    read = spark.sparkContext.accumulator(0)
    rows = 60

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    hour = F.timestamp_add("MONTH", (F.col("id") % 12).cast("int"), F.lit("2023-01-01 08:00:00").cast("timestamp"))
    trips = spark.range(rows).select(
        hour.alias("pickup_datetime"), (F.col("id") % 5).cast("int").alias("PULocationID"), (F.col("id") % 3).cast("int").alias("DOLocationID"),
        F.lit(2).cast("int").alias("passenger_count"), hour.alias("dropoff_datetime"), F.lit(1.5).alias("trip_distance"),
        F.lit(9.0).alias("trip_duration_minutes"), F.lit(7.5).alias("fare_amount"))
    monkeypatch.setattr(fx, "trips", lambda *_: trips.mapInPandas(counted, trips.schema))
    got = {r["origin"]: (r["trips"], r["passengers"]) for r in catalogue.merge_by_pattern(spark, "").collect()}
    assert got == {kind: (20, 40) for kind in ("int", "long", "double")}
    assert read.value == rows
