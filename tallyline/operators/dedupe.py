"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_first(columns: Sequence[str]) -> list[Column]:
    """The order in which copies of a record are preferred, from the lineage columns that exist.

    All batches of one load carry the same ingestion time, so the batch date and then the record
    hash decide between them and the survivor does not depend on the run.
    """
    order = []
    if "ingestion_timestamp" in columns:
        order.append(F.col("ingestion_timestamp").desc_nulls_last())
    if "batch_date" in columns:
        order.append(F.col("batch_date").desc_nulls_last())
    if "record_hash" in columns:
        order.append(F.col("record_hash").asc_nulls_last())
    return order


def top_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row of every key.

    ``row_number() = 1`` lets Spark drop all but one row per key in each task before the shuffle
    (WindowGroupLimit), so a key with a third of all rows sends one row per task, not all of them.
    """
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rn") == 1).drop("_rn")


def deduplicate_by_key(
    df: DataFrame, key: str | Sequence[str], order: Sequence[Column] | None = None
) -> DataFrame:
    """Newest row per key. Where lineage columns leave a tie, the smallest row content wins."""
    keys = [key] if isinstance(key, str) else list(key)
    if order is None:
        order = newest_first(df.columns)
        if "record_hash" not in df.columns:
            order += [F.col(f"`{c}`").asc_nulls_last() for c in df.columns if c not in keys]
    return top_per_key(df, keys, list(order) or [F.lit(1)])
