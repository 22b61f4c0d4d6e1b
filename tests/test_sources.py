"""Readers, mapping, merge, zone tables and written documents."""

import json

import pytest
from pyspark.sql import functions as F

from flowatlas.operators import report
from flowatlas.session import scratch_path, shared_root
from flowatlas.sources import sinks, zones
from flowatlas.sources.trips import (IBB_MAPPING, TRIP_SCHEMA, merge_sources, read_any, read_months, read_trips, require_columns, split_trips,
                                     to_trips)

CSV = """pickup_datetime,dropoff_datetime,PULocationID,DOLocationID,trip_distance,trip_duration_minutes,fare_amount,passenger_count
2023-01-01 00:00:00,2023-01-01 00:10:00,1,2,1.5,10,7.5,1
2023-01-01 00:00:00,nonsense,1.0,2,abc,10,7.5,
"""


def test_formats_and_lenient_values(spark, tmp_path):
    (tmp_path / "a.csv").write_text(CSV)
    (tmp_path / "a.tsv").write_text(CSV.replace(",", "\t"))
    rows = read_trips(spark, str(tmp_path / "a.csv")).collect()
    assert [r["PULocationID"] for r in rows] == [1, 1]
    assert rows[1]["dropoff_datetime"] is None and rows[1]["trip_distance"] is None
    assert rows == read_trips(spark, str(tmp_path / "a.tsv")).collect()
    records = [{"pickup_datetime": "2023-01-01 00:00:00", "dropoff_datetime": "2023-01-01 00:01:30", "PULocationID": 1,
                "DOLocationID": 2, "trip_distance": 2.0, "fare_amount": 3.0, "passenger_count": 1}]
    (tmp_path / "a.json").write_text(json.dumps(records))
    assert read_trips(spark, str(tmp_path / "a.json")).first()["trip_duration_minutes"] == 1.5
    with pytest.raises(ValueError, match="unsupported"):
        read_any(spark, "x.xlsx")
    with pytest.raises(ValueError, match="no input"):
        read_any(spark, str(tmp_path / "none*.csv"))


def test_json_layouts(spark, tmp_path):
    records = [{"pickup_datetime": "2023-01-01 00:00:00", "dropoff_datetime": "2023-01-01 00:01:30", "PULocationID": k,
                "DOLocationID": 2, "trip_distance": 2.0, "fare_amount": 3.0, "passenger_count": 1} for k in range(5)]
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(r) for r in records))
    (tmp_path / "array.json").write_text(json.dumps(records, indent=1))
    (tmp_path / "one.json").write_text(json.dumps(records[0], indent=1))
    (tmp_path / "several.json").write_text("\n".join(json.dumps(r, indent=1) for r in records))
    assert [read_trips(spark, str(tmp_path / f"{n}.json")).count() for n in ("lines", "array", "one")] == [5, 5, 1]
    with pytest.raises(ValueError, match="more than one root"):
        read_any(spark, str(tmp_path / "several.json"))
    with pytest.raises(ValueError, match="more than one root"):
        read_any(spark, str(tmp_path / "lines.json"), layout="document")
    with pytest.raises(ValueError, match="layout"):
        read_any(spark, str(tmp_path / "lines.json"), layout="x")


def test_dotted_dates_and_mixed_months(spark, tmp_path):
    (tmp_path / "d.csv").write_text(CSV.replace("2023-01-01", "15.01.2023"))
    rows = read_trips(spark, str(tmp_path / "d.csv"), timestamp_formats=["dd.MM.yyyy HH:mm:ss"]).collect()
    assert rows[0]["pickup_datetime"].day == 15 and rows[1]["dropoff_datetime"] is None
    trips = read_trips(spark, str(tmp_path / "d.csv"))
    trips.write.parquet(str(tmp_path / "a.parquet"))
    trips.withColumn("passenger_count", F.col("passenger_count").cast("double")).write.parquet(str(tmp_path / "b.parquet"))
    merged = read_months(spark, [str(tmp_path / "a.parquet"), str(tmp_path / "b.parquet")])
    assert merged.count() == 4 and merged.schema == TRIP_SCHEMA


def test_mapping_skips_absent_and_gate_names_missing(spark):
    df = spark.createDataFrame([("2023-01-01 00:00:00", "2023-01-01 01:00:00", 1, 2, 3.0)],
                               "BINIS_TARIH string, INIS_TARIH string, BINIS_BOLGE_ID int, INIS_BOLGE_ID int, MESAFE_KM double")
    with pytest.raises(ValueError, match="fare_amount.*passenger_count"):
        to_trips(df, IBB_MAPPING)
    full = df.withColumn("UCRET", F.lit(1.0)).withColumn("YOLCU_SAYISI", F.lit(2))
    trips = to_trips(full, IBB_MAPPING)
    assert trips.schema.names == TRIP_SCHEMA.names
    assert trips.first()["trip_duration_minutes"] == 60.0


def test_merge(spark, tmp_path):
    for name in ("b", "a"):
        (tmp_path / f"{name}.csv").write_text(CSV)
    paths = [str(tmp_path / f"{n}.csv") for n in ("b", "a")]
    assert merge_sources(spark, paths).count() == 4
    (tmp_path / "bad.csv").write_text("x\n1\n")
    with pytest.raises(ValueError, match="missing"):
        merge_sources(spark, [*paths, str(tmp_path / "bad.csv")])
    with pytest.raises(ValueError):
        merge_sources(spark, [])
    with pytest.raises(ValueError):
        require_columns(spark.range(1))


def test_merge_by_pattern_leaves_out_its_output(spark, tmp_path):
    rows = [("2023-01-01 00:00:00", "2023-01-01 00:10:00", 1, 2, 3.0, 10.0, 5.0, 1)]
    df = spark.createDataFrame(rows, "pickup_datetime string, dropoff_datetime string, PULocationID int, DOLocationID int, trip_distance double, "
                                     "trip_duration_minutes double, fare_amount double, passenger_count int")
    for name, kind in (("a", "int"), ("b", "long"), ("c", "double"), ("d", "int")):
        df.withColumn("passenger_count", F.col("passenger_count").cast(kind)).write.parquet(str(tmp_path / f"{name}.parquet"))
    (tmp_path / "e.csv").write_text("x\n1\n")
    output = str(tmp_path / "merged.parquet")
    for _ in range(2):
        merged = merge_sources(spark, str(tmp_path / "*.parquet"), output, "origin")
        assert dict(merged.dtypes)["passenger_count"] == "double" and merged.count() == 4
        merged.write.mode("overwrite").parquet(output)
    assert {r["origin"].split("/")[-2] for r in spark.read.parquet(output).collect()} == {f"{n}.parquet" for n in "abcd"}
    # Inputs of one schema are one scan.
    assert merged._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 3
    with pytest.raises(ValueError, match="no input"):
        merge_sources(spark, str(tmp_path / "*.tsv"))


def test_rejected_rows_go_aside_in_one_scan(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "BINIS_TARIH,INIS_TARIH,BINIS_BOLGE_ID,INIS_BOLGE_ID,MESAFE_KM,UCRET,YOLCU_SAYISI\n"
        "01.02.2023 10:00:00,01.02.2023 10:30:00,1,2,3.5,10,1\n"
        "soon,01.02.2023 10:30:00,1,2,3.5,10,1\n"
        "01.02.2023 10:00:00,01.02.2023 10:30:00,x,2,far,10,1\n"
        "01.02.2023 10:00:00,01.02.2023 10:30:00,1,2,,10,\n")
    raw = read_any(spark, str(tmp_path / "t.csv"))
    trips, rejected, counts = split_trips(raw, str(tmp_path / "out"), IBB_MAPPING, ["dd.MM.yyyy HH:mm:ss"])
    assert counts == {"kept": 2, "unreadable pickup_datetime": 1, "unreadable PULocationID": 1}
    assert trips.schema == TRIP_SCHEMA and {r["trip_distance"] for r in trips.collect()} == {3.5, None}
    assert {(r["reason"], json.loads(r["raw"])["trip_distance"]) for r in rejected.collect()} == {
        ("unreadable pickup_datetime", "3.5"), ("unreadable PULocationID", "far")}
    empty = split_trips(raw.limit(0), str(tmp_path / "none"), IBB_MAPPING)
    assert empty[2] == {} and empty[0].count() == 0 and empty[1].count() == 0


def test_zone_files(spark, tmp_path):
    lookup, centroid = tmp_path / "lookup.csv", tmp_path / "centroids.csv"
    lookup.write_bytes('﻿"LocationID","Borough","Zone","service_zone"\n1,"A"," North ","x"\nx,"A","Bad","x"\n2,"A","  ","x"\n3,"A","South","x"\n'.encode())
    centroid.write_text("LocationID,zone,borough,centroid_lat,centroid_lon\n1,N,A,40.5,-73.9\n3,S,A,?,-73\n")
    rows = {r["zone_id"]: r for r in zones.zones_from_files(spark, str(lookup), str(centroid)).collect()}
    assert {k: r["zone_name"] for k, r in rows.items()} == {1: "North", 3: "South"}
    assert rows[1]["latitude"] == 40.5 and rows[3]["latitude"] is None
    assert zones.zones_from_files(spark, str(tmp_path / "no.csv"), str(centroid)).count() == 0


def test_city_config_and_registry(spark, tmp_path):
    config = {"name": "Town", "country": "X", "zones": {"1": "A", "2": "B"}, "hotspots": [1],
              "coordinates": {"1": [51.5, -0.1]}}
    path = tmp_path / "town.json"
    path.write_text(json.dumps(config))
    row = zones.read_city_config(spark, str(path)).first()
    assert (row["currency"], row["base_fare"], row["timezone"]) == ("USD", 3.5, "UTC")
    zones.register_city("Town", lambda s: zones.zones_from_config(zones.read_city_config(s, str(path))))
    table = {r["zone_id"]: r for r in zones.city_zones(spark, " town ").collect()}
    assert table[1]["is_hotspot"] and not table[2]["is_hotspot"] and table[2]["latitude"] is None
    assert "town" in zones.list_cities()
    with pytest.raises(ValueError, match="unknown city"):
        zones.city_zones(spark, "nowhere")
    literal = zones.zones_from_rows(spark, [(1, "A", 1.0, 2.0, True, False, False)])
    assert literal.schema.names == zones.ZONE_SCHEMA.names


def test_zone_meta_optional_columns(spark, tmp_path):
    (tmp_path / "meta.csv").write_text("id,name,lat\n1,A,3.5\n2,,\n")
    rows = zones.read_zone_meta(spark, str(tmp_path / "meta.csv")).orderBy("id").collect()
    assert rows[0]["lat"] == 3.5 and rows[0]["hub"] is None and rows[1]["name"] is None


def test_map_reader_defaults(spark, tmp_path):
    document = {"nodes": [{"id": 1, "name": "A", "rank": 4}, {"id": 2, "name": "B", "lat": 1.5, "zone_type": "hub"}],
                "edges": [{"src": 1, "dst": 2}, {"src": 1}]}
    path = tmp_path / "map.json"
    path.write_text(json.dumps(document))
    nodes, edges = report.read_map_document(spark, str(path))
    rows = {r["id"]: r for r in nodes.collect()}
    assert (rows[1]["lat"], rows[1]["zone_type"], rows[2]["rank"]) == (0.0, "normal", 999)
    assert [tuple(r) for r in edges.collect()] == [(1, 2, 1)]


def test_sinks(spark, tmp_path):
    df = spark.range(3)
    for name in ("t.parquet", "t.csv", "t.tsv", "t.json"):
        sinks.write_table(df, str(tmp_path / name))
        sinks.write_table(df, str(tmp_path / name))
    assert spark.read.parquet(str(tmp_path / "t.parquet")).count() == 3
    with pytest.raises(ValueError):
        sinks.write_table(df, str(tmp_path / "t.npz"))


def test_scratch_is_below_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_root(spark))
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
