"""Session defaults and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


def build_session(app: str = "flowatlas", master: str | None = None, shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """Session with the defaults the operators are written for.

    Memory, executors and master normally come from spark-submit; only settings that
    change plans are given here.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master may run without the setting; it then gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="flowatlas-")
    return _LOCAL_ROOTS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder for one written table."""
    return os.path.join(shared_root(spark), "scratch", uuid.uuid4().hex, name)


#: Rows of an aggregation or sort that one task holds, about.
ROWS_PER_TASK = 1_000_000


@contextmanager
def widened(spark: SparkSession, rows: int):
    """While inside, shuffles have a partition per ``ROWS_PER_TASK`` of ``rows``, if that is more than the session's number.

    A task's hash map or sort then does not grow with the tables. Only for work that is written inside; its shuffle files go when their job ends.
    """
    with shuffles_released(spark):
        with _partitions(spark, rows):
            yield


@contextmanager
def _partitions(spark: SparkSession, rows: int):
    wanted = {"spark.sql.shuffle.partitions": str(rows // ROWS_PER_TASK), "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}
    before = {key: spark.conf.get(key) for key in wanted}
    if rows // ROWS_PER_TASK <= int(before["spark.sql.shuffle.partitions"]):
        yield
        return
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint and continue from the files.

    Cuts the lineage, so a lost executor costs a re-read and not a re-run of the loop.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint(eager=True)


def store(df: DataFrame) -> DataFrame:
    """Like ``settle``, as a written table.

    For loops that join a state with itself: a checkpoint keeps the size Spark estimated for the plan,
    a product over its joins, which then squares in every round until planning stalls. A table
    has the size of its files.
    """
    path = scratch_path(df.sparkSession, "table.parquet")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession):
    """Jobs begun inside remove their shuffle files when they end, so loops do not pile them up. For work that ``settle`` or ``store`` writes inside."""
    before = spark.conf.get(_RELEASE, None)
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.unset(_RELEASE) if before is None else spark.conf.set(_RELEASE, before)


def discard(df: DataFrame) -> None:
    """Remove the files that ``settle`` or ``store`` wrote for ``df``: a state whose successor is written. Nothing may read it any more."""
    context = df.sparkSession.sparkContext
    plan = df._jdf.queryExecution().analyzed()
    kind = plan.getClass().getSimpleName()
    if kind == "LogicalRDD" and plan.rdd().getCheckpointFile().isDefined():
        path = plan.rdd().getCheckpointFile().get()
    elif kind == "LogicalRelation" and "/scratch/" in (root := plan.relation().location().rootPaths().head().toString()):
        path = root
    else:
        return
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(context._jsc.hadoopConfiguration()).delete(found, True)
