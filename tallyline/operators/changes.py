"""Change detection between two snapshots and its application."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions import business_key, record_hash
from tallyline.operators.skew import skew_join

INSERT, UPDATE, DELETE, NO_CHANGE = "insert", "update", "delete", "no_change"
CHANGE_TYPES = (INSERT, UPDATE, DELETE, NO_CHANGE)
# Columns a change set has on top of the record.
CHANGE_COLUMNS = ("change_type", "delta_business_key", "delta_detected_at")


def _present(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for k in keys:
        present = present & F.col(f"`{k}`").isNotNull()
    return present


def _hashed(df: DataFrame, keys: Sequence[str], hash_col: str, fields: Sequence[str]) -> DataFrame:
    if hash_col in df.columns:
        return df
    return df.withColumn(hash_col, record_hash([c for c in fields if c not in keys]))


def detect_changes(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    hash_col: str = "record_hash",
    detected_at: datetime | None = None,
) -> DataFrame:
    """Compare a new snapshot with the current one: insert, update, delete or no_change per key.

    The rows carry the source record; a delete carries the key and the target's hash. Both sides
    hold one row per key (deduplicate first). A record without ``hash_col`` is hashed over its
    other columns. Of the target only keys and hash are shuffled. Rows lacking a key part match
    nothing and are neither inserted nor deleted: they come out as no_change, and they are kept out
    of the join, where they would all meet in one task.
    """
    keys = list(keys)
    fields = [c for c in source.columns if c != hash_col and c in target.columns]
    source, target = _hashed(source, keys, hash_col, fields), _hashed(target, keys, hash_col, fields)
    old = target.select(*keys, F.col(hash_col).alias("_old_hash"), F.lit(True).alias("_in_target"))
    new = source.withColumn("_in_source", F.lit(True))
    joined = new.where(_present(keys)).join(old.where(_present(keys)), keys, "full")
    keyless = new.where(~_present(keys)).unionByName(old.where(~_present(keys)), allowMissingColumns=True)

    hash_differs = ~F.col(hash_col).eqNullSafe(F.col("_old_hash"))
    kind = (
        F.when(~_present(keys), NO_CHANGE)
        .when(F.col("_in_target").isNull(), INSERT)
        .when(F.col("_in_source").isNull(), DELETE)
        .when(hash_differs, UPDATE)
        .otherwise(NO_CHANGE)
    )
    stamp = F.current_timestamp() if detected_at is None else F.lit(detected_at)
    return joined.unionByName(keyless, allowMissingColumns=True).select(
        *[
            F.coalesce(hash_col, "_old_hash").alias(c) if c == hash_col else F.col(f"`{c}`")
            for c in source.columns
        ],
        kind.alias("change_type"),
        business_key(*keys).alias("delta_business_key"),
        stamp.alias("delta_detected_at"),
    )


def change_set(detected: DataFrame) -> DataFrame:
    """The rows that change something. Write them out before applying: once the current table has
    moved on, evaluating the comparison again would find no change."""
    return detected.where(F.col("change_type") != NO_CHANGE)


def record_columns(changes: DataFrame) -> list[str]:
    return [c for c in changes.columns if c not in CHANGE_COLUMNS]


def apply_changes(current: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The next version of ``current``: deleted rows gone, updated rows replaced, new rows added.

    An update or delete without a row to act on does nothing, and an insert whose key is already
    there is skipped, so applying the same change set twice gives the same table. ``current`` is
    only ever the streamed side of a join, so a small change set is broadcast by Spark and the
    table is not shuffled.
    """
    keys = list(keys)
    changes = change_set(changes)
    gone = changes.where(F.col("change_type") != INSERT).select(*keys)
    kept = skew_join(current, gone, keys, "left_anti", hot=False)
    known = skew_join(current.select(*keys), changes.select(*keys), keys, "left_semi", hot=False)
    updated = changes.where(F.col("change_type") == UPDATE).join(known, keys, "left_semi")
    inserted = changes.where(F.col("change_type") == INSERT).join(known, keys, "left_anti")
    records = [c for c in record_columns(changes) if c in current.columns]
    arriving = updated.unionByName(inserted).select(*records)
    return kept.select(*current.columns).unionByName(arriving, allowMissingColumns=True)


def upsert(current: DataFrame, incoming: DataFrame, keys: Sequence[str], hash_col: str = "record_hash") -> DataFrame:
    """Replace rows whose hash differs and add rows whose key is new; nothing is deleted.

    Both sides hold one row per key. Hashes are compared null-safely and an equal hash keeps the
    current row. As in apply_changes, the current table is only streamed.
    """
    keys = list(keys)
    known = skew_join(
        current.select(*keys, F.col(hash_col).alias("_old_hash"), F.lit(True).alias("_known")),
        incoming.select(*keys),
        keys,
        "left_semi",
        hot=False,
    )
    same = F.col("_known").isNotNull() & F.col("_old_hash").eqNullSafe(F.col(hash_col))
    arriving = skew_join(incoming, known, keys, "left", hot=False).where(~same).select(*incoming.columns)
    kept = skew_join(current, arriving.select(*keys), keys, "left_anti", hot=False).select(*current.columns)
    return kept.unionByName(
        arriving.select(*[c for c in incoming.columns if c in current.columns]), allowMissingColumns=True
    )
