"""Cleaning, aggregation, ordering, zoning, geometry and similarity on small fixtures."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from flowatlas.functions.scalar import compact_count, slug
from flowatlas.operators import cleaning, geo, graph, quality, zoning
from flowatlas.operators.embed import cosine_neighbours
from flowatlas.operators.ordering import exact_median, global_rank, running_total
from flowatlas.operators.removal import Removal
from flowatlas.operators.skew import join_unique
from flowatlas.sources.trips import TRIP_SCHEMA, read_trips


@pytest.fixture(scope="module")
def trip_rows():
    rng = random.Random(5)
    rows = []
    for i in range(400):
        start = dt.datetime(2023, 1 + i % 12, 3, i % 24)
        minutes = rng.choice([0.0, -2.0, 5.0, 20.0, 300.0, 301.0])
        rows.append((start, start + dt.timedelta(minutes=minutes), rng.randrange(4), rng.randrange(4),
                     rng.choice([0.0, 0.05, 1.5, 7.25]), minutes, rng.choice([0.0, 3.5, 12.25]), rng.randrange(3)))
    return rows


def kept(row, strict=False):
    _, _, pu, do, dist, dur, fare, riders = row
    base = dist > 0 and 0 < dur <= 300 and not (pu == do and dist < 0.1)
    return base and (not strict or (fare > 0 and riders > 0))


def test_edges_and_reports(spark, trip_rows):
    trips = spark.createDataFrame(trip_rows, TRIP_SCHEMA)
    for profile in ("base", "strict"):
        want = {}
        for row in trip_rows:
            if kept(row, profile == "strict") and row[2] != row[3]:
                want.setdefault((row[2], row[3]), []).append(row)
        want = {k: v for k, v in want.items() if len(v) >= 5}
        got = {(r["src"], r["dst"]): r for r in cleaning.od_edges(trips, profile, 5).collect()}
        assert got.keys() == want.keys()
        for key, rows in want.items():
            assert got[key]["weight"] == len(rows)
            assert got[key]["avg_duration"] == pytest.approx(statistics.fmean(r[5] for r in rows))
            assert got[key]["total_fare"] == pytest.approx(sum(r[6] for r in rows))
    report = {r["profile"]: r for r in cleaning.cleaning_report(trips).collect()}
    assert report["base"]["kept_rows"] == sum(map(kept, trip_rows))
    assert report["strict"]["removed_rows"] == 400 - sum(kept(r, True) for r in trip_rows)
    with pytest.raises(ValueError):
        cleaning.rules("loose")


def test_filters_reach_the_scan(spark, trip_rows, tmp_path):
    path = str(tmp_path / "trips.parquet")
    spark.createDataFrame(trip_rows, TRIP_SCHEMA).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", 10000)
    plan = cleaning.od_edges(read_trips(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(trip_distance,0.0)" in plan and "LessThanOrEqual(trip_duration_minutes,300.0)" in plan
    scan = plan[plan.index("ReadSchema"):]
    assert "pickup_datetime" not in scan and "passenger_count" not in scan
    assert plan.count("Exchange hashpartitioning") == 1


def test_quality_gate(spark, trip_rows):
    trips = spark.createDataFrame(trip_rows, TRIP_SCHEMA)
    row = quality.quality_report(trips).first()
    assert (row["status"], row["total_rows"], row["unique_pu"]) == ("OK", 400, 4)
    assert row["zero_distance"] == sum(r[4] <= 0 for r in trip_rows)
    failed = quality.quality_report(trips.drop("fare_amount", "trip_distance")).first()
    assert (failed["status"], failed["errors"]) == ("FAIL", "trip_distance,fare_amount")
    derived = quality.quality_report(trips.drop("trip_duration_minutes")).first()
    assert "duration_derived" in derived["warnings"] and derived["zero_duration"] == 0


def test_running_total_and_rank(spark):
    rng = random.Random(1)
    rows = [(i, rng.randrange(50), rng.randrange(9)) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, score int, n int").repartition(7)
    order = [F.desc("score"), F.asc("id")]
    want = sorted(rows, key=lambda r: (-r[1], r[0]))
    ranks = {r["id"]: r["rank"] for r in global_rank(df, order).collect()}
    assert ranks == {r[0]: i + 1 for i, r in enumerate(want)}
    sums = {r["id"]: r["upto"] for r in running_total(df, order, F.col("n"), "upto").collect()}
    total = 0
    for r in want:
        total += r[2]
        assert sums[r[0]] == total


@pytest.mark.parametrize("values", [[3], [1, 2], [5, 1, 1, 9], [2, 2, 2, 8, 9], list(range(101))])
def test_median(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    assert exact_median(df, "v").first()[0] == statistics.median(values)


def test_join_unique_is_a_plain_join(spark, layout):
    big = spark.createDataFrame([(0 if i % 3 == 0 else i, i) for i in range(90)], "k int, x int")
    small = spark.createDataFrame([(i, i * 10) for i in range(0, 90, 2)], "k int, y int")
    for how in ("inner", "left"):
        got = sorted(map(tuple, join_unique(big, small, ["k"], how=how).select("k", "x", "y").collect()), key=str)
        assert got == sorted(map(tuple, big.join(small, "k", how).select("k", "x", "y").collect()), key=str)


def test_histogram_and_constant_column(spark):
    df = spark.createDataFrame([(v,) for v in [1, 1, 2, 5, 11]], "weight long")
    bins = {r["bin"]: r["n"] for r in graph.histogram(df, "weight", 5).collect()}
    assert bins == {0: 3, 2: 1, 4: 1}
    flat = spark.createDataFrame([(7,), (7,)], "weight long")
    row = graph.histogram(flat, "weight", 50).first()
    assert (row["bin"], row["n"], row["lower"]) == (25, 2, 7.0)


def test_undirected_and_subgraphs(spark):
    edges = spark.createDataFrame([(1, 2, 5), (2, 1, 7), (2, 3, 1)], "src long, dst long, weight long")
    sums = {(r["src"], r["dst"]): r["weight"] for r in graph.undirected(edges).collect()}
    assert sums == {(1, 2): 12, (2, 3): 1}
    assert graph.undirected(edges, combine="max").agg(F.max("weight")).first()[0] == 7
    two = spark.createDataFrame([(1,), (2,)], "id long")
    assert graph.induced_subgraph(edges, two).count() == 2
    assert graph.remove_vertices(edges, two.filter("id = 1")).count() == 1
    ratio = graph.isolated_ratio(graph.add_isolated(two, spark.createDataFrame([(8,), (9,)], "id long")), edges).first()
    assert (ratio["nodes"], ratio["isolated"], ratio["fragmented"]) == (4, 2, True)


def test_removal_of_a_bridge_splits_once(spark):
    edges = spark.createDataFrame(
        [(1, 0, 4), (2, 0, 4), (0, 3, 4), (3, 4, 4), (4, 3, 4), (1, 2, 4)], "src long, dst long, weight long")
    scores = spark.createDataFrame([(0, 0.5), (3, 0.2), (4, 0.1), (1, 0.1), (2, 0.1)], "id long, pagerank double")
    rows = sorted(Removal(edges, scores, k=2).timeline().collect(), key=lambda r: r["step"])
    assert [r["remaining_flow"] for r in rows] == [24, 12, 4]
    assert [r["num_components"] for r in rows] == [1, 2, 2]
    assert [r["splits"] for r in rows] == [False, True, False]
    assert [r["nodes_remaining"] for r in rows] == [5, 4, 3]
    assert rows[2]["cumulative_loss"] == pytest.approx(100 - 100 * 4 / 24)
    assert rows[1]["avg_path"] == 1.0


def test_auto_tiers(spark, trip_rows):
    trips = spark.createDataFrame(trip_rows, TRIP_SCHEMA)
    tiers = zoning.auto_tiers(trips, None, hotspot_pct=0.3, secondary_pct=0.4).orderBy("rank").collect()
    assert [r["tier"] for r in tiers] == ["hotspot", "secondary", "normal", "normal"]
    assert tiers[0]["name"] == f"Zone-{tiers[0]['id']}"
    assert sum(r["flow"] for r in tiers) == 800


def test_polygon_centroid(spark):
    rows = [(1, 0, 0.0, 0.0), (1, 1, 4.0, 0.0), (1, 2, 4.0, 2.0), (1, 3, 0.0, 2.0),
            (2, 0, 0.0, 0.0), (2, 1, 3.0, 0.0), (2, 2, 0.0, 3.0), (3, 0, 1.0, 1.0), (3, 1, 3.0, 3.0)]
    got = {r["zone_id"]: r for r in geo.polygon_centroids(
        spark.createDataFrame(rows, "zone_id int, k int, x double, y double")).collect()}
    assert (got[1]["area"], got[1]["x"], got[1]["y"]) == (8.0, 2.0, 1.0)
    assert (got[2]["area"], got[2]["x"], got[2]["y"]) == (4.5, 1.0, 1.0)
    assert (got[3]["area"], got[3]["x"]) == (0.0, 2.0)


def test_cosine_neighbours(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(40)] + [(99, [0.0] * 8)]
    vectors = spark.createDataFrame(rows, "id long, vector array<double>")
    anchors = spark.createDataFrame([(3,), (7,)], "id long")
    near = cosine_neighbours(vectors, anchors, 4)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    data = dict(rows[:40])

    def cosine(a, b):
        return sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5

    for anchor in (3, 7):
        want = sorted((i for i in data if i != anchor), key=lambda i: -cosine(data[anchor], data[i]))[:4]
        got = [r["id"] for r in sorted(near.filter(f"anchor = {anchor}").collect(), key=lambda r: r["place"])]
        assert got == want


def test_text_functions(spark):
    df = spark.createDataFrame([("İstanbul Şişli", 1234567), ("Ağ ı ö", 999_500), ("NYC", 12)], "name string, n long")
    rows = df.select(slug(F.col("name")).alias("s"), compact_count(F.col("n")).alias("c")).collect()
    assert [r["s"] for r in rows] == ["istanbul_sisli", "ag__o", "nyc"]
    assert [r["c"] for r in rows] == ["1,2M", "1000K", "12"]
    others = spark.createDataFrame([("São Tomé Kâğıthane Łódź ñ ǆ ﬀ ộ",)], "name string")
    assert others.select(slug(F.col("name"))).first()[0] == "sao_tome_kagthane_odz_n_dz_ff_o"


def test_sums_are_not_rounded_and_nan_is_no_distance(spark):
    rows = [(1, 2, 1.23456789, 5.0, 1e15, 1), (1, 2, 2.0, 5.0, 0.123456789, 1), (1, 2, float("nan"), 5.0, 1.0, 1), (1, 2, 1.0, float("nan"), 1.0, 1)]
    trips = spark.createDataFrame(rows, "PULocationID int, DOLocationID int, trip_distance double, trip_duration_minutes double, fare_amount double, passenger_count int")
    edge = cleaning.od_edges(trips, min_trips=1).first()
    assert (edge["weight"], edge["avg_distance"], edge["total_fare"]) == (2, pytest.approx(1.617283945, abs=1e-12), pytest.approx(1e15 + 0.123456789))


def test_reports_keep_empty_variants(spark):
    rows = [(1, 2, 1.0, 5.0, 0.0, 0)]
    trips = spark.createDataFrame(rows, "PULocationID int, DOLocationID int, trip_distance double, trip_duration_minutes double, fare_amount double, passenger_count int")
    ablation = {r["variant"]: r["kept_rows"] for r in cleaning.filter_ablation(trips, 1).collect()}
    assert ablation == {"distance": 1, "distance_duration": 1, "base": 1, "base_fare": 0, "base_passenger": 0}
    assert {r["profile"]: r["edges"] for r in cleaning.profile_comparison(trips, 1).collect()} == {"base": 1, "strict": 0}
    assert cleaning.threshold_sweep(trips.limit(0)).count() == 5
