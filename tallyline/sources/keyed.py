"""A table in key-hash parts whose versions share the parts that did not change.

A version writes the parts that its changes touch, and a list that says which version holds each part.
The data are written first and the list last, so a version is there as a whole or not at all; writing a
version again replaces it. Older versions stay readable. Parts are plain partition folders
(``version=<v>/key_part=<n>``) and lists are small tables beside them.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.operators import changes as cdc
from tallyline.sources.sinks import delete_folder, store

PART = "key_part"
LIST = "key_part int, holder string"
SCHEMA_ROW = -1
WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a path; none if it is not there."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    return sorted(x.getPath().getName() for x in files.listStatus(folder) if x.isDirectory())


def is_there(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path; 0 if it is not there."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.getContentSummary(folder).getLength() if files.exists(folder) else 0


class KeyedTable:
    """``parts`` counts when the table is made and holds for all its versions: about the bytes of the table
    over a few hundred MB, the number of shuffle partitions unless given.

    The driver knows the list of parts, never rows. Keys are unique. Rows that lack a key part can be
    neither updated nor deleted; they are dealt out by their whole row.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], parts: int | None = None) -> None:
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)
        self._wanted = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    @cached_property
    def parts(self) -> int:
        made = child_folders(self.spark, f"{self.root}/_parts")
        return int(made[0].partition("=")[2]) if made else self._wanted

    def _folder(self, version: str) -> str:
        return f"{self.root}/version={version}"

    def _list_folder(self, version: str) -> str:
        return f"{self.root}/_lists/version={version}"

    def dealt(self, df: DataFrame) -> DataFrame:
        """The rows with the part they belong to."""
        whole = None
        for k in self.keys:
            here = F.col(f"`{k}`").isNotNull()
            whole = here if whole is None else whole & here
        # whole numbers hash alike whatever their width
        widened = [F.col(f"`{k}`").cast("long") if df.schema[k].dataType in WHOLE else F.col(f"`{k}`") for k in self.keys]
        spread: Column = F.when(whole, F.xxhash64(*widened)).otherwise(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
        return df.withColumn(PART, F.pmod(spread, F.lit(self.parts)).cast("int"))

    def _listed(self, version: str) -> tuple[T.StructType, dict[int, str]]:
        """The schema of a version, which its list holds in a row of its own, and the holders of its parts."""
        rows = {r[PART]: r["holder"] for r in self.spark.read.schema(LIST).parquet(self._list_folder(version)).collect()}
        return T.StructType.fromJson(json.loads(rows.pop(SCHEMA_ROW))), rows

    def holders(self, version: str) -> dict[int, str]:
        """Which version holds each part that has rows."""
        return self._listed(version)[1]

    def versions(self) -> list[str]:
        return [x.partition("=")[2] for x in child_folders(self.spark, f"{self.root}/_lists")]

    def _write(self, dealt: DataFrame, version: str, others: dict[int, str], tasks: int) -> None:
        folder = self._folder(version)
        store(dealt.repartition(max(1, tasks), PART), folder, partition_by=[PART])
        written = {int(x.partition("=")[2]): version for x in child_folders(self.spark, folder)}
        holders = {p: v for p, v in others.items() if p not in written} | written
        rows = [(SCHEMA_ROW, dealt.drop(PART).schema.json()), *sorted(holders.items())]
        self.spark.createDataFrame(rows, LIST).coalesce(1).write.mode("overwrite").parquet(self._list_folder(version))

    def create(self, df: DataFrame, version: str) -> None:
        """The first version: every part is written."""
        made = f"{self.root}/_parts/of={self.parts}"
        self.spark.createDataFrame([(self.parts,)], "parts int").coalesce(1).write.mode("overwrite").parquet(made)
        self._write(self.dealt(df), version, {}, self.parts)

    def read(self, version: str, parts: Iterable[int] | None = None) -> DataFrame:
        """A version, or some of its parts. Only the folders of these parts are listed and read."""
        schema, wanted = self._listed(version)
        if parts is not None:
            keep = set(parts)
            wanted = {p: v for p, v in wanted.items() if p in keep}
        if not wanted:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self._folder(v)}/{PART}={p}" for p, v in sorted(wanted.items())]
        return self.spark.read.schema(schema).parquet(*paths)

    def touched(self, changes: DataFrame) -> list[int]:
        """The parts that a change set reaches."""
        present = changes.where(F.col("change_type") != cdc.NO_CHANGE).dropna(subset=self.keys)
        return sorted(r[PART] for r in self.dealt(present.select(*self.keys)).select(PART).distinct().collect())

    def apply(self, base: str, version: str, changes: DataFrame) -> list[int]:
        """The version after ``base``: the touched parts are read, changed and written, the others are shared.

        ``changes`` is read more than once; store it first. Returns the parts that were written anew.
        """
        parts = self.touched(changes)
        current = self.read(base, parts)
        records = changes.select(*[c for c in cdc.record_columns(changes) if c in current.columns], "change_type")
        after = cdc.apply_changes(current, records, self.keys)
        untouched = {p: v for p, v in self.holders(base).items() if p not in set(parts)}
        self._write(self.dealt(after), version, untouched, len(parts))
        return parts

    def compare(self, latest: DataFrame, base: str, hash_col: str = "record_hash", detected_at: datetime | None = None) -> DataFrame:
        """Changes from a version to a full snapshot. Of the stored rows only keys and hash are read."""
        return cdc.change_set(cdc.detect_changes(latest, self.read(base), self.keys, hash_col, detected_at))

    def upsert(
        self, base: str, version: str, incoming: DataFrame, store: Callable[[DataFrame], DataFrame], hash_col: str = "record_hash"
    ) -> list[int]:
        """Merge rows by key and hash: equal ones write nothing, nothing is deleted.

        Only the parts that hold incoming keys are compared, by key and hash, and only those with a new or
        changed row are written. ``incoming`` has one row per key and is read more than once; ``store`` puts
        the change set into a table, as ``sources.staged`` does.
        """
        asked = self.dealt(incoming.dropna(subset=self.keys).select(*self.keys))
        parts = [r[PART] for r in asked.select(PART).distinct().collect()]
        known = self.read(base, parts).join(asked.select(*self.keys), self.keys, "left_semi")
        return self.apply(base, version, store(cdc.change_set(cdc.detect_changes(incoming, known, self.keys, hash_col))))

    def drop_unused(self, keep: Iterable[str]) -> list[str]:
        """Forget all versions but those to keep, and delete the parts that none of these holds."""
        kept = set(keep)
        used = {(v, p) for version in kept for p, v in self.holders(version).items()}
        dropped = []
        for version in self.versions():
            if version not in kept:
                delete_folder(self.spark, self._list_folder(version))
        for name in child_folders(self.spark, self.root):
            holder = name.partition("=")[2]
            if not name.startswith("version="):
                continue
            for part in child_folders(self.spark, f"{self.root}/{name}"):
                if (holder, int(part.partition("=")[2])) not in used:
                    delete_folder(self.spark, f"{self.root}/{name}/{part}")
                    dropped.append(f"{name}/{part}")
            if holder not in kept and not child_folders(self.spark, f"{self.root}/{name}"):
                delete_folder(self.spark, f"{self.root}/{name}")
        return dropped
