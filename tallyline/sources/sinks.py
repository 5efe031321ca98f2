"""Writers. Each write is one Spark job committed by the output committer, so lost tasks are rerun safely."""

from __future__ import annotations

import itertools
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import cache
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Record hashes are hexadecimal text, which only a codec with an entropy stage makes smaller.
CODEC = "zstd"
# Spark's switch for removing the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_switch = threading.Lock()
_writing: WeakKeyDictionary[SparkSession, list] = WeakKeyDictionary()  # writes under way, and the switch as it was


def _scratch(spark: SparkSession) -> str:
    """This application's own folder under the shared folder that ``spark.checkpoint.dir`` names."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = _local_root()
    return f"{root.rstrip('/')}/tallyline/{spark.sparkContext.applicationId}"


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tallyline-")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared folder that the cluster names in ``spark.checkpoint.dir``."""
    return f"{_scratch(spark)}/{purpose}-{uuid.uuid4().hex}"


def drop_staged(spark: SparkSession) -> None:
    """Remove everything this application has staged. Call it once its results have been written."""
    delete_folder(spark, _scratch(spark))


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written in here go when its write ends, not when the driver collects its garbage.

    A table that is read again is stored, so nothing asks for them again. Writes of several threads may overlap.
    """
    with _switch:
        here = _writing.setdefault(spark, [0, spark.conf.get(CLEANUP, "false")])
        here[0] += 1
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _switch:
            here[0] -= 1
            if not here[0]:
                spark.conf.set(CLEANUP, _writing.pop(spark)[1])


def store(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Store a table as parquet; nothing but its files is left of the work."""
    with shuffles_dropped(df.sparkSession):
        df.write.mode(mode).partitionBy(*partition_by).option("compression", CODEC).parquet(path)


def staged(df: DataFrame, purpose: str = "staged") -> DataFrame:
    """Store a derived table in the shared folder and read it back.

    Use it for a table that several later steps read: they then read files instead of computing it
    again, lost executors cost no recomputation, and Spark knows its size.
    """
    path = shared_dir(df.sparkSession, purpose)
    store(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession, path: str | None = None) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """``staged`` for tables that are needed until their result has been stored, at the end of the block.

    They lie in ``path`` or else in the shared folder.
    """
    root, steps = path or shared_dir(spark, "staging"), itertools.count()

    def stage(df: DataFrame) -> DataFrame:
        place = f"{root}/step-{next(steps)}"
        store(df, place)
        return spark.read.schema(df.schema).parquet(place)

    try:
        yield stage
    finally:
        delete_folder(spark, root)


def append_raw(df: DataFrame, path: str, partition_by: str = "batch_date") -> None:
    """Append to the raw layer, one folder per batch so that later reads prune to the batches they need."""
    store(df, path, "append", [partition_by])


def overwrite_table(df: DataFrame, path: str) -> None:
    """Replace a table. ``path`` must not be among the inputs of ``df``; use write_version for that."""
    store(df, path)


def write_version(df: DataFrame, path: str, version: int | str) -> str:
    """Write the next version beside the one being read. Writing a version twice leaves one copy."""
    target = f"{path.rstrip('/')}/version={version}"
    store(df, target)
    return target


def write_conformed(conformed: DataFrame, path: str) -> None:
    """Write valid and rejected records in one pass over the input.

    They land in ``record_status=valid`` and ``record_status=rejected``; a reader of either half
    lists only that folder.
    """
    status = F.when(F.col("invalid_reason") == "", F.lit("valid")).otherwise(F.lit("rejected"))
    store(conformed.withColumn("record_status", status), path, partition_by=["record_status"])


def export_changes(
    changes: DataFrame, base_path: str, entity: str, batch_id: str, num_files: int | None = None
) -> str:
    """Write everything but unchanged rows as CSV with a header; returns the folder.

    Files are written in parallel by default. A receiver that wants a set number of files gets it
    through a shuffle of the changed rows, which keeps the upstream work parallel.
    """
    path = f"{base_path.rstrip('/')}/{entity}_delta/batch_id={batch_id}"
    rows = changes.where(F.col("change_type") != "no_change")
    if num_files is not None:
        rows = rows.repartition(num_files)
    with shuffles_dropped(rows.sparkSession):
        rows.write.mode("overwrite").option("header", True).csv(path)
    return path
