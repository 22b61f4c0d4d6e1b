"""The job runner: a stage that fails, the next attempt, and readers that only see whole runs."""

import pytest
from pyspark.sql import functions as F

from flowatlas.plans import job


def test_a_failed_run_goes_on_behind_its_last_whole_stage(spark, tmp_path):
    folder, ran, broken = str(tmp_path / "run"), [], [True]

    def third(tables):
        ran.append("third")
        if broken[0]:
            # Fails while the table is being written.
            return tables["second"].select(F.assert_true(F.col("id") < 3).alias("x"), "id")
        return tables["second"].select((F.col("id") * 2).alias("id"))

    stages = [("first", lambda t: ran.append("first") or spark.range(5)), ("second", lambda t: ran.append("second") or t["first"].filter("id > 0")),
              ("third", third), ("fourth", lambda t: ran.append("fourth") or t["third"].agg(F.sum("id").alias("s")))]
    with pytest.raises(Exception):
        job.run_stages(spark, folder, stages)
    with pytest.raises(ValueError, match="no finished run"):
        job.read_run(spark, folder)
    assert ran == ["first", "second", "third"]
    broken[0] = False
    job.run_stages(spark, folder, stages)
    assert ran == ["first", "second", "third", "third", "fourth"]
    tables = job.read_run(spark, folder)
    assert list(tables) == ["first", "second", "third", "fourth"]
    assert tables["fourth"].first()["s"] == 20 and sorted(r["id"] for r in tables["third"].collect()) == [2, 4, 6, 8]
    job.run_stages(spark, folder, stages)
    assert len(ran) == 5
    assert [tuple(r) for r in job.inventory(tables, {"first": "id", "fourth": "s"}).orderBy("name").collect()] == [("first", 5, 10.0), ("fourth", 1, 20.0)]


def test_empty_tables_and_names(spark, tmp_path):
    stages = [("none", lambda t: spark.range(0))]
    job.run_stages(spark, str(tmp_path / "a"), stages)
    assert job.read_run(spark, str(tmp_path / "a"))["none"].count() == 0
    with pytest.raises(ValueError, match="different names"):
        job.run_stages(spark, str(tmp_path / "b"), stages * 2)
