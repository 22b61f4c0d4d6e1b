"""Trip sources: format dispatch, column mapping, derived duration, monthly merge."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DURATION = "trip_duration_minutes"

TRIP_SCHEMA = T.StructType([
    T.StructField("pickup_datetime", T.TimestampNTZType()),
    T.StructField("dropoff_datetime", T.TimestampNTZType()),
    T.StructField("PULocationID", T.IntegerType()),
    T.StructField("DOLocationID", T.IntegerType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField(DURATION, T.DoubleType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("passenger_count", T.IntegerType()),
])
REQUIRED = TRIP_SCHEMA.names

# Column mappings of two public trip feeds.
TLC_MAPPING = {
    "pickup_datetime": "tpep_pickup_datetime",
    "dropoff_datetime": "tpep_dropoff_datetime",
    "PULocationID": "PULocationID",
    "DOLocationID": "DOLocationID",
    "trip_distance": "trip_distance",
    "fare_amount": "fare_amount",
    "passenger_count": "passenger_count",
}
IBB_MAPPING = {
    "pickup_datetime": "BINIS_TARIH",
    "dropoff_datetime": "INIS_TARIH",
    "PULocationID": "BINIS_BOLGE_ID",
    "DOLocationID": "INIS_BOLGE_ID",
    "trip_distance": "MESAFE_KM",
    "fare_amount": "UCRET",
    "passenger_count": "YOLCU_SAYISI",
}


def _json_layout(spark: SparkSession, path: str) -> str:
    """``document`` if the files hold one array or object each, ``lines`` if every line is a record.

    Seen from the first line: a record that ends in it, or an array that does, can be read line by line.
    """
    first = spark.read.text(path).filter(F.trim("value") != "").select(F.trim("value")).first()
    text = first[0] if first else ""
    return "lines" if text[:1] + text[-1:] in ("{}", "[]", "") else "document"


def _read_documents(spark: SparkSession, path: str, exact: bool) -> DataFrame:
    """JSON files with one root value each; a file with more would lose all but the first, so it is refused.

    With ``exact``, numbers keep their text (1.10); else only their value (1.1).
    """
    roots = spark.read.text(path, wholetext=True).filter(F.col("value").rlike(r"^\s*\{[\s\S]*\}\s*\{") | F.col("value").rlike(r"\]\s*\[\s*\{"))
    if not roots.isEmpty():
        raise ValueError(f"{path}: more than one root value in a file; read it with layout='lines'")
    records = spark.read.option("multiLine", True).option("primitivesAsString", True).json(path)
    if exact or "_corrupt_record" in records.columns or not records.columns:
        return records
    # Parsed from memory: for the text of a number, the reader goes back to the file for every single one.
    parsed = F.from_json("value", T.ArrayType(records.schema))
    return spark.read.text(path, wholetext=True).select(F.explode(parsed).alias("record")).select("record.*")


def read_any(spark: SparkSession, path: str | list[str], layout: str | None = None, exact: bool = True) -> DataFrame:
    """Read by extension (glob patterns and lists of one format too). Text formats arrive as strings, so there is no
    inference scan; ``to_trips`` gives them their types.

    JSON records come one per line (``layout="lines"``) or as one array or object per file (``"document"``); for
    ``.json`` the layout is seen from the first line if it is not given. ``exact=False`` reads documents faster, numbers by value.
    """
    if layout not in (None, "lines", "document"):
        raise ValueError(f"unknown layout {layout!r}; use 'lines' or 'document'")
    first = path if isinstance(path, str) else path[0]
    extension = os.path.splitext(first.rstrip("/"))[1].lower()
    reader = spark.read
    if extension == ".parquet":
        load = reader.format("parquet").load
    elif extension == ".csv":
        load = reader.option("header", True).csv
    elif extension == ".tsv":
        load = reader.option("header", True).option("sep", "\t").csv
    elif extension == ".json":
        def load(path):
            if (layout or _json_layout(spark, path)) == "document":
                return _read_documents(spark, path, exact)
            return reader.option("primitivesAsString", True).json(path)
    elif extension in (".jsonl", ".ndjson"):
        load = reader.option("primitivesAsString", True).json
    else:
        raise ValueError(f"unsupported format {extension!r}: {path}")
    try:
        return load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise ValueError(f"no input matches {path}") from error
        raise


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Apply ``{target: source}``; sources the data does not have are skipped."""
    return df.withColumnsRenamed({s: t for t, s in mapping.items() if s in df.columns})


def lenient_timestamp(df: DataFrame, name: str, formats: list[str] | None = None) -> Column:
    """Zone-less timestamp; text that is not a date becomes null instead of failing the job.

    ``formats`` are tried in turn before the ISO form, for example ``dd.MM.yyyy HH:mm:ss``.
    """
    if dict(df.dtypes)[name] == "string":
        tried = [F.try_to_timestamp(F.col(name), F.lit(f)).cast("timestamp_ntz") for f in formats or []]
        return F.coalesce(*tried, F.expr(f"try_cast(`{name}` AS timestamp_ntz)"))
    return F.col(name).cast("timestamp_ntz")


def derive_duration(df: DataFrame, formats: list[str] | None = None) -> DataFrame:
    """Add the duration in minutes when the feed has none."""
    if DURATION in df.columns or not {"pickup_datetime", "dropoff_datetime"} <= set(df.columns):
        return df
    df = df.withColumns({c: lenient_timestamp(df, c, formats) for c in ("pickup_datetime", "dropoff_datetime")})
    micros = F.timestamp_diff("MICROSECOND", F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return df.withColumn(DURATION, micros / 60e6)


def require_columns(df: DataFrame, columns: list[str] = REQUIRED) -> DataFrame:
    """Exactly the required columns, or ``ValueError`` naming the missing ones."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*columns)


def to_trips(df: DataFrame, mapping: dict[str, str] | None = None, timestamp_formats: list[str] | None = None) -> DataFrame:
    """Rename, derive the duration and give every column its declared type."""
    return _typed(rename_columns(df, mapping or {}), timestamp_formats)


def _typed(df: DataFrame, timestamp_formats: list[str] | None, *others: str) -> DataFrame:
    """The required columns with their types, and ``others`` as they are."""
    df = derive_duration(df, timestamp_formats)
    require_columns(df)
    columns = []
    for field in TRIP_SCHEMA:
        if df.schema[field.name].dataType == field.dataType:
            value = F.col(field.name)  # untouched, so filters on it still reach the scan
        elif isinstance(field.dataType, T.TimestampNTZType):
            value = lenient_timestamp(df, field.name, timestamp_formats)
        elif isinstance(field.dataType, T.IntegerType):
            # "3.0" is how integer columns with gaps arrive as text.
            value = F.col(field.name).try_cast("double").try_cast("int")
        else:
            value = F.col(field.name).try_cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns, *others)


def split_trips(df: DataFrame, folder: str, mapping: dict[str, str] | None = None,
                timestamp_formats: list[str] | None = None) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """``(trips, rejected, counts)``: one pass writes the readable trips and the others, with their reason, below ``folder``.

    A row is rejected if a required column holds text that its type cannot take; the first such column gives the reason
    (``unreadable pickup_datetime``). Nulls and blank text are missing values, not unreadable ones, and are kept.
    ``rejected`` is ``(reason, raw)`` with the row as it came as JSON. ``counts`` has the rows of every
    outcome, ``kept`` included, observed while they are written.
    """
    df = rename_columns(df, mapping or {})
    given = [c for c in REQUIRED if c in df.columns]
    rows = _typed(df.withColumn("_raw", F.struct(*df.columns)), timestamp_formats, "_raw")

    def unreadable(name: str) -> Column:
        return F.col(name).isNull() & (F.trim(F.col(f"_raw.{name}").cast("string")) != "")

    reason = F.coalesce(*[F.when(unreadable(c), F.lit(f"unreadable {c}")) for c in given], F.lit("kept"))
    outcomes = ["kept", *[f"unreadable {c}" for c in given]]
    seen = Observation()
    rows = rows.withColumn("reason", reason).observe(seen, *[F.count_if(F.col("reason") == o).alias(o) for o in outcomes])
    raw = F.when(F.col("reason") != "kept", F.to_json("_raw")).alias("raw")
    rows.select(*REQUIRED, raw, "reason").write.partitionBy("reason").parquet(folder)
    schema = T.StructType([*TRIP_SCHEMA, T.StructField("raw", T.StringType()), T.StructField("reason", T.StringType())])
    written = df.sparkSession.read.schema(schema).parquet(folder)
    counts = {name: n for name, n in seen.get.items() if n}
    return written.filter(F.col("reason") == "kept").select(*REQUIRED), written.filter(F.col("reason") != "kept").select("reason", "raw"), counts


def read_trips(spark: SparkSession, path: str, mapping: dict[str, str] | None = None, layout: str | None = None,
               timestamp_formats: list[str] | None = None) -> DataFrame:
    return to_trips(read_any(spark, path, layout, exact=bool(timestamp_formats)), mapping, timestamp_formats)


def read_months(spark: SparkSession, paths: list[str], mapping: dict[str, str] | None = None) -> DataFrame:
    """Several inputs whose columns may differ in type (an integer in one month, a double in the next): each one is read
    and cast on its own before the union."""
    if not paths:
        raise ValueError("no input files")
    parts = [read_trips(spark, path, mapping) for path in sorted(set(paths))]
    return reduce(DataFrame.unionByName, parts)


def matching_inputs(spark: SparkSession, pattern: str, output: str | None = None) -> list[str]:
    """Files and table folders that match ``pattern``, in name order, without ``output`` and what lies in it."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def qualified(path: str):
        path = jvm.org.apache.hadoop.fs.Path(path)
        system = path.getFileSystem(conf)
        return system, system.makeQualified(path)

    system, path = qualified(pattern)
    found = sorted(str(status.getPath()) for status in system.globStatus(path) or [])
    if output is not None:
        own = str(qualified(output)[1])
        found = [f for f in found if f != own and not f.startswith(own + "/")]
    return found


def merge_sources(spark: SparkSession, paths: str | list[str], output: str | None = None, origin: str | None = None) -> DataFrame:
    """Bag union of several inputs, given one by one or as a pattern; each must have the required columns.

    Types come from the schemas alone (footers, for Parquet): inputs of the same format and schema are one scan, and columns that differ
    in type between scans (an integer, a long, a double) get the type that holds both. ``output`` is left out, so that
    a merge written next to its inputs can be repeated. ``origin`` names a column for the file a row came from.
    """
    found = matching_inputs(spark, paths, output) if isinstance(paths, str) else sorted(set(paths))
    if not found:
        raise ValueError(f"no input files: {paths}")
    scans: dict[tuple, list[str]] = {}
    for path in found:
        part = read_any(spark, path)
        require_columns(part)
        # Column order counts: the header of the first of several text files is taken for all.
        scans.setdefault((os.path.splitext(path)[1].lower(), part.schema.json()), []).append(path)
    parts = []
    for group in scans.values():
        part = read_any(spark, group)
        parts.append(part.select(*REQUIRED, *([F.col("_metadata.file_path").alias(origin)] if origin else [])))
    return reduce(DataFrame.unionByName, parts)
