"""File streams into the raw layer, into a keyed table and into change sets."""

from tallyline.streaming.classify import ChangeFeed, classify_stream, fold_changes, read_changes
from tallyline.streaming.drift import DriftingFeed, SchemaLog, ingest_drifting, read_drifted
from tallyline.streaming.ingest import ingest_stream, read_stream_csv, read_stream_parquet
from tallyline.streaming.upsert import compact, read_current, upsert_stream

__all__ = [
    "ChangeFeed",
    "DriftingFeed",
    "SchemaLog",
    "classify_stream",
    "compact",
    "fold_changes",
    "ingest_drifting",
    "ingest_stream",
    "read_changes",
    "read_current",
    "read_drifted",
    "read_stream_csv",
    "read_stream_parquet",
    "upsert_stream",
]
