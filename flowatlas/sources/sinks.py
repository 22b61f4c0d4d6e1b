"""Written results: Parquet, CSV, TSV, JSON lines, the sectioned map document, and vectors with their neighbours."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str) -> str:
    """Overwrite ``path`` in the format of its extension."""
    extension = os.path.splitext(path)[1].lower()
    writer = df.write.mode("overwrite")
    if extension == ".parquet":
        writer.parquet(path)
    elif extension == ".csv":
        writer.option("header", True).csv(path)
    elif extension == ".tsv":
        writer.option("header", True).option("sep", "\t").csv(path)
    elif extension in (".json", ".jsonl"):
        writer.json(path)
    else:
        raise ValueError(f"unsupported format {extension!r}: {path}")
    return path


def write_map_document(sections: dict[str, DataFrame], path: str) -> str:
    """One JSON-lines folder per section of the map document.

    ``nodes`` grows with the graph, so it is written by all tasks instead of being gathered
    into one row; a viewer reads the sections it shows.
    """
    for name, section in sections.items():
        section.write.mode("overwrite").json(os.path.join(path, name))
    return path


def write_vectors(vectors: DataFrame, neighbours: DataFrame, path: str) -> str:
    """``(id, vector)`` and the pairs ``(anchor, id, similarity, place)`` as two Parquet tables below ``path``."""
    vectors.select("id", "vector").write.mode("overwrite").parquet(os.path.join(path, "vectors"))
    neighbours.select("anchor", "id", "similarity", "place").write.mode("overwrite").parquet(os.path.join(path, "neighbours"))
    return path


def read_vectors(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(vectors, neighbours) written by ``write_vectors``."""
    return spark.read.parquet(os.path.join(path, "vectors")), spark.read.parquet(os.path.join(path, "neighbours"))
