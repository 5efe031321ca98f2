"""Readers, lineage columns and writers."""

from tallyline.sources.files import (
    malformed,
    read_batch_csv,
    read_checked_csv,
    read_checked_json,
    read_json,
    read_labels,
    read_table,
    string_schema,
    well_formed,
)
from tallyline.sources.keyed import KeyedTable
from tallyline.sources.lineage import add_ingestion_metadata, with_record_hash
from tallyline.sources.publish import (
    Limit,
    completeness_limits,
    completeness_measures,
    gated_write,
    measured,
    publish,
    published,
    read_audit,
    read_published,
)
from tallyline.sources.sinks import (
    append_raw,
    drop_staged,
    export_changes,
    overwrite_table,
    shared_dir,
    shuffles_dropped,
    staged,
    staging,
    store,
    write_conformed,
    write_version,
)

__all__ = [
    "KeyedTable",
    "Limit",
    "add_ingestion_metadata",
    "append_raw",
    "completeness_limits",
    "completeness_measures",
    "drop_staged",
    "export_changes",
    "gated_write",
    "malformed",
    "measured",
    "overwrite_table",
    "publish",
    "published",
    "read_audit",
    "read_batch_csv",
    "read_checked_csv",
    "read_checked_json",
    "read_json",
    "read_labels",
    "read_published",
    "read_table",
    "shared_dir",
    "shuffles_dropped",
    "staged",
    "staging",
    "store",
    "string_schema",
    "well_formed",
    "with_record_hash",
    "write_conformed",
    "write_version",
]
