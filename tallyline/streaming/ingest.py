"""Incremental ingest of landed files. The checkpoint remembers which files have been read."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyline.sources import add_ingestion_metadata, string_schema


def read_stream_csv(
    spark: SparkSession, path: str, columns: Iterable[str], files_per_trigger: int = 10_000
) -> DataFrame:
    """CSV files with a header as a stream of text columns; new files are picked up as they land."""
    return (
        spark.readStream.schema(string_schema(columns))
        .option("header", True)
        .option("enforceSchema", False)
        .option("maxFilesPerTrigger", files_per_trigger)
        .csv(path)
    )


def read_stream_parquet(
    spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*", files_per_trigger: int = 10_000
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(path)
    )


def ingest_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    source_system: str,
    load_id: str,
    ingested_at: datetime | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Append the stream with its lineage columns to the raw layer, exactly once per file.

    With ``available_now`` the query reads what has landed, in bounded batches, and stops; run it
    again with the same checkpoint to take up only what is new.
    """
    rows = add_ingestion_metadata(stream, source_system, load_id, ingested_at)
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
