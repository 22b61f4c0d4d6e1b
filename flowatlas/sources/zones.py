"""Zone dimension: lookup, centroid and meta CSVs, city config JSON, registry of cities."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ZONE_SCHEMA = T.StructType([
    T.StructField("zone_id", T.IntegerType(), False),
    T.StructField("zone_name", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("is_hotspot", T.BooleanType()),
    T.StructField("is_secondary", T.BooleanType()),
    T.StructField("is_hub", T.BooleanType()),
])

CITY_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("zones", T.MapType(T.StringType(), T.StringType())),
    T.StructField("hotspots", T.ArrayType(T.IntegerType())),
    T.StructField("secondary_hotspots", T.ArrayType(T.IntegerType())),
    T.StructField("transport_hubs", T.ArrayType(T.IntegerType())),
    T.StructField("coordinates", T.MapType(T.StringType(), T.ArrayType(T.DoubleType()))),
    T.StructField("currency", T.StringType()),
    T.StructField("base_fare", T.DoubleType()),
    T.StructField("per_km_fare", T.DoubleType()),
    T.StructField("timezone", T.StringType()),
])

# Defaults of a city config.
CITY_DEFAULTS = {"currency": "USD", "base_fare": 3.5, "per_km_fare": 2.5, "timezone": "UTC"}


def _read_csv(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    return df.toDF(*[c.lstrip("﻿").strip('"') for c in df.columns])


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """``(zone_id, zone_name)``; rows without an integer id or with a blank name are skipped."""
    return (
        _read_csv(spark, path)
        .select(F.trim("LocationID").try_cast("int").alias("zone_id"), F.trim("Zone").alias("zone_name"))
        .filter(F.col("zone_id").isNotNull() & (F.col("zone_name") != ""))
    )


def read_centroids(spark: SparkSession, path: str) -> DataFrame:
    """``(zone_id, latitude, longitude)``; rows that do not parse are skipped."""
    return _read_csv(spark, path).select(
        F.trim("LocationID").try_cast("int").alias("zone_id"),
        F.trim("centroid_lat").try_cast("double").alias("latitude"),
        F.trim("centroid_lon").try_cast("double").alias("longitude"),
    ).dropna()


def read_zone_meta(spark: SparkSession, path: str) -> DataFrame:
    """``(id, name, lat, lon, hub)`` from CSV, TSV or Parquet; absent optional columns are null."""
    if path.lower().endswith(".parquet"):
        df = spark.read.parquet(path)
    elif path.lower().endswith((".csv", ".tsv")):
        sep = "\t" if path.lower().endswith(".tsv") else ","
        df = spark.read.option("header", True).option("sep", sep).csv(path)
    else:
        raise ValueError(f"unsupported zone meta format: {path}")
    types = {"id": "int", "name": "string", "lat": "double", "lon": "double", "hub": "int"}
    return df.select(*[
        (F.col(c).try_cast(t) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in types.items()
    ])


def read_city_config(spark: SparkSession, path: str) -> DataFrame:
    """The config as one typed row, defaults filled in."""
    raw = spark.read.schema(CITY_SCHEMA).option("multiLine", True).json(path)
    return raw.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in CITY_DEFAULTS.items()})


def zones_from_config(config: DataFrame) -> DataFrame:
    """Explode a city config into the zone table."""
    def listed(column: str):
        return F.coalesce(F.array_contains(column, F.col("zone_id")), F.lit(False))

    lists = ["hotspots", "secondary_hotspots", "transport_hubs", "coordinates"]
    return (
        config.select(F.explode("zones").alias("_id", "zone_name"), *lists)
        .withColumn("zone_id", F.col("_id").cast("int"))
        .select(
            "zone_id", "zone_name",
            F.try_element_at(F.try_element_at("coordinates", F.col("_id")), F.lit(1)).alias("latitude"),
            F.try_element_at(F.try_element_at("coordinates", F.col("_id")), F.lit(2)).alias("longitude"),
            listed("hotspots").alias("is_hotspot"),
            listed("secondary_hotspots").alias("is_secondary"),
            listed("transport_hubs").alias("is_hub"),
        )
    )


def zones_from_files(spark: SparkSession, lookup: str, centroids: str) -> DataFrame:
    """Zone table of a lookup file with coordinates from a centroid file; both may be absent."""
    def or_empty(read, path, schema):
        try:
            return read(spark, path)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return spark.createDataFrame([], schema)

    names = or_empty(read_zone_lookup, lookup, "zone_id int, zone_name string")
    places = or_empty(read_centroids, centroids, "zone_id int, latitude double, longitude double")
    flags = {c: F.lit(False) for c in ("is_hotspot", "is_secondary", "is_hub")}
    return names.join(places, "zone_id", "left").withColumns(flags).select(*ZONE_SCHEMA.names)


def zones_from_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Zone table from literal rows in the order of ``ZONE_SCHEMA``."""
    return spark.createDataFrame(rows, ZONE_SCHEMA)


_CITIES: dict[str, Callable[[SparkSession], DataFrame]] = {}


def register_city(name: str, loader: Callable[[SparkSession], DataFrame]) -> None:
    """Make a zone table available by name."""
    _CITIES[name.lower().strip()] = loader


def list_cities() -> list[str]:
    return list(_CITIES)


def city_zones(spark: SparkSession, name: str) -> DataFrame:
    key = name.lower().strip()
    if key not in _CITIES:
        raise ValueError(f"unknown city {name!r}; registered: {', '.join(_CITIES) or 'none'}")
    return _CITIES[key](spark)
