"""Change sets from a stream: every micro-batch is compared with what is known by key and hash.

What is known is an index of one row per key (its hash, how new it was, whether it is deleted), kept in
key-hash parts with a version per batch. A batch reads the index of the batch before it, and of that only
the parts of its own keys, and writes its change set and the index parts that move on. Both are named by
the batch id and depend on nothing else, so a batch that is run again writes the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.functions import business_key, record_hash
from tallyline.operators.changes import DELETE, INSERT, NO_CHANGE, UPDATE
from tallyline.operators.dedupe import top_per_key
from tallyline.sources.keyed import KeyedTable, child_folders

HASH = "record_hash"
#: Columns of the index beside the keys.
SEEN, GONE = "seen_at", "is_deleted"


@dataclass(frozen=True)
class ChangeFeed:
    """How a stream is compared: its keys, what makes a row newer, and which rows are deletes.

    ``newer`` are columns that grow with a key's versions, NULL being the oldest. A key's newest row of a
    batch counts; a row no newer than the last one seen of its key is late or a replay and changes nothing.
    ``deleted`` is a SQL condition over the rows. ``hashed`` are the columns whose change is an update, all but
    keys and ``newer`` unless given; a stream that has a ``record_hash`` is compared by it.
    """

    keys: Sequence[str]
    newer: Sequence[str]
    deleted: str | None = None
    hashed: Sequence[str] | None = None
    parts: int | None = None

    def index(self, spark: SparkSession, root: str) -> KeyedTable:
        return KeyedTable(spark, f"{root}/index", self.keys, self.parts)

    def newest(self, batch: DataFrame) -> DataFrame:
        """One row per key with its hash, age and mark; rows lacking a key part can be compared with nothing."""
        rows = batch.dropna(subset=list(self.keys))
        if HASH not in rows.columns:
            fields = self.hashed or [c for c in rows.columns if c not in self.keys and c not in self.newer]
            rows = rows.withColumn(HASH, record_hash(fields))
        gone = F.lit(False) if self.deleted is None else F.coalesce(F.expr(self.deleted), F.lit(False))
        rows = rows.withColumns({SEEN: F.struct(*self.newer), GONE: gone})
        # a delete wins over a row of the same age, and the hash decides between others
        return top_per_key(rows, list(self.keys), [F.col(SEEN).desc(), F.col(GONE).desc(), F.col(HASH)])

    def classified(self, newest: DataFrame, known: DataFrame) -> DataFrame:
        """The rows with ``change_type`` and whether the index moves on with them."""
        old = known.select(*self.keys, F.col(HASH).alias("_old_hash"), F.col(SEEN).alias("_old_seen"), F.col(GONE).alias("_old_gone"))
        joined = newest.join(old, list(self.keys), "left")
        unknown = F.col("_old_seen").isNull()
        later = unknown | (F.col(SEEN) > F.col("_old_seen"))
        there = ~unknown & ~F.coalesce("_old_gone", F.lit(False))
        kind = (
            F.when(~later, NO_CHANGE)
            .when(F.col(GONE), F.when(there, DELETE).otherwise(NO_CHANGE))
            .when(~there, INSERT)
            .when(F.col(HASH).eqNullSafe(F.col("_old_hash")), NO_CHANGE)
            .otherwise(UPDATE)
        )
        return joined.withColumns({"change_type": kind, "_later": later, "_new": unknown})

    def change_set(self, classified: DataFrame) -> DataFrame:
        """The changes as batch comparison has them: the record, or for a delete its key and the hash that it had."""
        delete = F.col("change_type") == DELETE
        helpers = (SEEN, GONE, "_later", "_new", "_old_hash", "_old_seen", "_old_gone", "change_type")
        record = [
            F.when(delete, F.col("_old_hash")).otherwise(F.col(HASH)).alias(HASH) if c == HASH
            else F.col(f"`{c}`") if c in self.keys else F.when(~delete, F.col(f"`{c}`")).alias(c)
            for c in classified.columns if c not in helpers
        ]
        changes = classified.where(F.col("change_type") != NO_CHANGE)
        return changes.select(*record, "change_type", business_key(*self.keys).alias("delta_business_key"))

    def take(self, batch: DataFrame, batch_id: int, root: str) -> None:
        """Write the change set of one batch and the index after it."""
        spark = batch.sparkSession
        index, version = self.index(spark, root), str(batch_id)
        rows = self.newest(batch).persist()
        earlier = [int(v) for v in index.versions() if int(v) < batch_id]
        if not earlier:
            index.create(rows.select(*self.keys, HASH, SEEN, GONE).where("false"), "-1")
        before = str(max(earlier, default=-1))
        touched = [r["key_part"] for r in index.dealt(rows.select(*self.keys)).select("key_part").distinct().collect()]
        found = self.classified(rows, index.read(before, touched)).persist()
        self.change_set(found).write.mode("overwrite").parquet(f"{root}/changes/batch_id={batch_id}")
        moves = F.when(F.col("_new"), INSERT).otherwise(UPDATE)
        index.apply(before, version, found.where("_later").select(*self.keys, HASH, SEEN, GONE, moves.alias("change_type")))
        found.unpersist()
        rows.unpersist()


def classify_stream(stream: DataFrame, root: str, checkpoint: str, feed: ChangeFeed, available_now: bool = True) -> StreamingQuery:
    """Write a change set per micro-batch below ``root``; see ``ChangeFeed``.

    An unchanged row writes nothing, and one that is only newer moves the index alone, so that a late row
    between the two is still known to be late.
    """
    writer = stream.writeStream.foreachBatch(lambda batch, batch_id: feed.take(batch, batch_id, root))
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_changes(spark: SparkSession, root: str) -> DataFrame:
    """All change sets, with the batch that each belongs to."""
    return spark.read.parquet(f"{root}/changes")


def fold_changes(spark: SparkSession, root: str, table: KeyedTable, upto: int | None = None) -> str | None:
    """Apply the change sets that a keyed table does not have yet, in order; returns its newest version.

    Versions are named by batch. A table without a version starts empty.
    """
    names = child_folders(spark, f"{root}/changes")
    batches = sorted(int(x.partition("=")[2]) for x in names)
    have = [int(v) for v in table.versions()]
    last = max(have) if have else None
    for batch_id in batches:
        if (last is not None and batch_id <= last) or (upto is not None and batch_id > upto):
            continue
        changes = spark.read.parquet(f"{root}/changes/batch_id={batch_id}")
        if last is None:
            table.create(changes.drop("change_type", "delta_business_key").where("false"), "-1")
            last = -1
        table.apply(str(last), str(batch_id), changes)
        last = batch_id
    return None if last is None else str(last)
