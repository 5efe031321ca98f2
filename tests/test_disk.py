"""What is left on disk of a table that has been stored: its files."""

import os
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyline import sources
from tallyline.plans import catalog
from tallyline.plans.lifecycle import Batch, Job
from tallyline.sources import sinks
from tests.fixtures import land


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_") and name.endswith(".data")}


def _counted(spark, n):
    return spark.range(n).groupBy((F.col("id") % 97).alias("k")).agg(F.count("*").alias("n"))


def test_storing_leaves_no_shuffle_files(spark, tmp_path):
    before = _shuffle_files(spark)
    sources.staged(_counted(spark, 5000))
    sources.overwrite_table(_counted(spark, 5000), str(tmp_path / "t"))
    sources.write_version(_counted(spark, 5000), str(tmp_path / "v"), 1)
    with sources.staging(spark) as stage:
        assert len(stage(_counted(spark, 5000)).collect()) == 97
    assert _shuffle_files(spark) <= before


def test_the_switch_is_put_back_when_the_last_write_ends(spark):
    was = spark.conf.get(sinks.CLEANUP, "false")
    with pytest.raises(ValueError), sources.shuffles_dropped(spark):
        with sources.shuffles_dropped(spark):
            assert spark.conf.get(sinks.CLEANUP) == "true"
        assert spark.conf.get(sinks.CLEANUP) == "true"
        raise ValueError
    assert spark.conf.get(sinks.CLEANUP, "false") == was


def test_staging_removes_its_tables(spark, tmp_path):
    with sources.staging(spark, str(tmp_path / "steps")) as stage:
        first, second = stage(spark.range(3)), stage(spark.range(4))
        assert (first.count(), second.count()) == (3, 4)
    assert not os.path.exists(tmp_path / "steps")


def test_stored_tables_are_written_with_an_entropy_coder(spark, tmp_path):
    sources.overwrite_table(spark.range(9), str(tmp_path / "t"))
    path = sorted((tmp_path / "t").glob("*.parquet"))[-1]
    assert pq.ParquetFile(path).metadata.row_group(0).column(0).compression == "ZSTD"


def test_the_load_job_leaves_no_intermediate_tables(spark, tmp_path):
    job = Job(spark, str(tmp_path / "lake"))
    job.run(Batch("b1", datetime(2026, 1, 20)), land(tmp_path / "one", ["2026-01-01", "2026-01-15"]))
    assert sorted(os.listdir(tmp_path / "lake" / "matched")) in (
        ["entity", "sponsor", "study_contract", "study_contract_best"],
        ["entity", "sponsor", "steps", "study_contract", "study_contract_best"],
    )
    for left in (tmp_path / "lake" / "matched" / "steps", tmp_path / "lake" / "target_stage" / "invoice"):
        assert not left.exists() or not os.listdir(left)


def test_a_shared_table_leaves_nothing_that_was_staged_for_it(spark, tmp_path):
    made = []

    def build(stage):
        made.append(stage(spark.range(3)))
        return made[0].selectExpr("id + 1 AS id")

    got = catalog._once(spark, str(tmp_path), "things", build)
    assert sorted(r.id for r in got.collect()) == [1, 2, 3]
    assert not os.path.exists(made[0].inputFiles()[0].removeprefix("file://")) and len(made) == 1
    catalog._once(spark, str(tmp_path), "things", build)
    assert len(made) == 1
