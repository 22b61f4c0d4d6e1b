"""Clean a document corpus for training: stages that are written as Parquet and read again one after the other."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from flowatlas.llm import bpe, decontaminate, minhash, quality, secrets
from flowatlas.llm.common import read_table
from flowatlas.session import shared_root


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from the labels, does not reject."""
    return quality.accepted(docs, quality.known_labels(spark, sf_dir))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without too much of a benchmark item in them."""
    return decontaminate.cleaned(docs, read_table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    return secrets.redacted(docs, secrets.findings(docs))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE ids of every document that is left, with digests of the ids and of the text decoded from them."""
    return bpe.tokenized(docs, bpe.default_path())


STAGES = [("quality", keep_good), ("near_duplicates", keep_one_of_each), ("decontaminate", drop_contaminated),
          ("secrets", mask_secrets), ("bpe", tokenise)]

#: No SQL: the stages hold trained models and a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = os.path.join(shared_root(spark), "pipeline", uuid.uuid4().hex)
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}_{name}.parquet"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
