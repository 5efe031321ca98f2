"""A keyed table fed by a stream.

Each micro-batch writes its newest row per key to a folder named by the batch id, replacing that
folder if the batch is replayed, so running a batch twice changes nothing. The table is the newest
row per key over these folders; ``compact`` folds them into one from time to time. No batch reads
or rewrites the rows of earlier ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.operators.dedupe import top_per_key


def upsert_stream(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[Column],
    available_now: bool = True,
) -> StreamingQuery:
    """Keep the first row per key by ``order``, over everything the stream delivers."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        top_per_key(batch, keys, order).write.mode("overwrite").parquet(f"{root}/changes/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_current(
    spark: SparkSession,
    root: str,
    keys: Sequence[str],
    order: Sequence[Column],
    compacted_to: int | None = None,
    deleted: Column | None = None,
) -> DataFrame:
    """The table. Give ``compacted_to`` to read the folded table and only the batches after it.

    Keys whose newest row is ``deleted`` are left out. Such rows stay in the log and in folded tables,
    so a row that arrives late does not bring a deleted key back.
    """
    changes = spark.read.parquet(f"{root}/changes")
    if compacted_to is not None:
        changes = changes.where(F.col("batch_id") > compacted_to)
        base = spark.read.parquet(f"{root}/base/upto={compacted_to}")
        rows = base.unionByName(changes.drop("batch_id"), allowMissingColumns=True)
    else:
        rows = changes.drop("batch_id")
    newest = top_per_key(rows, keys, order)
    return newest if deleted is None else newest.where(~F.coalesce(deleted, F.lit(False)))


def compact(
    spark: SparkSession,
    root: str,
    keys: Sequence[str],
    order: Sequence[Column],
    upto: int,
    compacted_to: int | None = None,
) -> None:
    """Fold the batches up to ``upto`` into one table beside the one in use."""
    changes = spark.read.parquet(f"{root}/changes").where(F.col("batch_id") <= upto)
    if compacted_to is not None:
        changes = changes.where(F.col("batch_id") > compacted_to)
    rows = changes.drop("batch_id")
    if compacted_to is not None:
        rows = rows.unionByName(spark.read.parquet(f"{root}/base/upto={compacted_to}"))
    top_per_key(rows, keys, order).write.mode("overwrite").parquet(f"{root}/base/upto={upto}")
