"""Ingest of CSV files whose columns change over time, with a log of the schemas seen.

The stream delivers file names only. Each micro-batch reads the header of each of its files, groups the
files by header and parses each group once, by name. The log holds a version for every set of columns,
each named by the batch that opened it, so a batch that is run again finds the versions before it and
writes the same.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyline.sources import add_ingestion_metadata, read_checked_csv, string_schema
from tallyline.sources.files import PARSE_ERROR, RAW_LINE
from tallyline.sources.keyed import child_folders

RESCUED, VERSION, STATUS = "rescued", "schema_version", "parse_status"
#: What a file source of whole files delivers; only the path is read here.
FILES = "path string, modificationTime timestamp, length long, content binary"
LOG = "position int, name string, batch_id long, file string"
LINEAGE = "source_file_name string, batch_date string, source_system string, ingestion_timestamp timestamp, load_id string, record_hash string"


@dataclass(frozen=True)
class SchemaVersion:
    number: int
    columns: tuple[str, ...]
    batch_id: int
    file: str


class SchemaLog:
    """The versions of a feed's columns, beside its checkpoint; one small table each."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, f"{root.rstrip('/')}/schema_log"

    def versions(self) -> list[SchemaVersion]:
        out = []
        for name in child_folders(self.spark, self.root):
            rows = self.spark.read.schema(LOG).parquet(f"{self.root}/{name}").orderBy("position").collect()
            out.append(SchemaVersion(int(name.partition("=")[2]), tuple(r["name"] for r in rows), rows[0]["batch_id"], rows[0]["file"]))
        return sorted(out, key=lambda v: v.number)

    def before(self, batch_id: int) -> SchemaVersion | None:
        """The version in force when a batch starts."""
        earlier = [v for v in self.versions() if v.batch_id < batch_id]
        return earlier[-1] if earlier else None

    def latest(self) -> SchemaVersion:
        return self.versions()[-1]

    def write(self, version: SchemaVersion) -> None:
        rows = [(i, c, version.batch_id, version.file) for i, c in enumerate(version.columns)]
        self.spark.createDataFrame(rows, LOG).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/version={version.number}")


def _path(spark: SparkSession, name: str):
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name)) if "://" in name or "%" in name else jvm.org.apache.hadoop.fs.Path(name)


def header(spark: SparkSession, name: str, sep: str = ",") -> tuple[str, ...]:
    """The column names in a file's first line, read by the driver; none in an empty file."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = _path(spark, name)
    stream = path.getFileSystem(conf).open(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        line = reader.readLine()
    finally:
        reader.close()
    names = next(csv.reader([(line or "").lstrip("﻿")], delimiter=sep), [])
    return tuple(x.strip() for x in names)


def _by_name(names: Sequence[str], known: Sequence[str]) -> tuple[dict[str, int], dict[str, int]]:
    """Places of the known columns in a header and of the others, by the name they are rescued under.

    Names match whatever their case. A name that comes again, and an empty one, belongs to no column.
    """
    wanted = {c.lower(): c for c in known}
    found: dict[str, int] = {}
    others: dict[str, int] = {}
    for i, name in enumerate(names):
        column = wanted.get(name.lower())
        if column is not None and column not in found:
            found[column] = i
        else:
            others[name if name and name not in others and column is None else f"{name}#{i}"] = i
    return found, others


def _additions(known: Sequence[str], headers: Iterable[Sequence[str]]) -> list[str]:
    """New column names in the order in which they appear."""
    seen, out = {c.lower() for c in known}, []
    for names in headers:
        for name in names:
            if name and name.lower() not in seen:
                seen.add(name.lower())
                out.append(name)
    return out


@dataclass(frozen=True)
class DriftingFeed:
    """A feed of CSV files. ``columns`` are those to start with, the first files' own unless given.

    With ``evolve``, a new column opens a schema version; without, its values go to the map column
    ``rescued``, as do values under repeated or empty names. A column that a file lacks is NULL. Broken
    lines are kept apart with their reason (see ``read_checked_csv``).
    """

    source_system: str
    load_id: str
    columns: Sequence[str] = ()
    evolve: bool = True
    ingested_at: datetime | None = None
    sep: str = ","

    def take(self, files: DataFrame, batch_id: int, root: str) -> None:
        spark = files.sparkSession
        names = sorted(r["path"] for r in files.collect())
        with ThreadPoolExecutor(8) as pool:
            headers = dict(zip(names, pool.map(lambda x: header(spark, x, self.sep), names), strict=True))
        log = SchemaLog(spark, root)
        now = log.before(batch_id)
        filled = [(x, headers[x]) for x in names if headers[x]]
        known = list(self.columns) if now is None else list(now.columns)
        fresh = _additions(known, (h for _, h in filled)) if self.evolve or not known else []
        if fresh or now is None:
            if not (known or fresh):
                return  # only empty files so far
            opened_by = next((x for x, h in filled if _additions(known, [h])), names[0] if names else "")
            now = SchemaVersion((now.number if now else 0) + 1, (*known, *fresh), batch_id, opened_by)
            log.write(now)
        groups: dict[tuple[str, ...], list[str]] = {}
        for x, h in filled:
            groups.setdefault(h, []).append(_path(spark, x).toString())
        rows = None
        for names_of, paths in groups.items():
            part = self._read(spark, paths, names_of, now)
            rows = part if rows is None else rows.unionByName(part)
        if rows is not None:
            rows.write.mode("overwrite").partitionBy(STATUS).parquet(f"{root}/raw/batch_id={batch_id}")

    def _read(self, spark: SparkSession, paths: list[str], names: Sequence[str], version: SchemaVersion) -> DataFrame:
        places = [f"_{i}" for i in range(len(names))]
        raw = read_checked_csv(spark, paths, places, self.sep)
        found, others = _by_name(names, version.columns)
        values: list[Column] = [(F.col(places[found[c]]) if c in found else F.lit(None).cast("string")).alias(c) for c in version.columns]
        rescued: Column = F.lit(None).cast("map<string,string>")
        if others:
            pairs = [x for name, i in others.items() for x in (F.lit(name), F.col(places[i]))]
            filled = F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull())
            rescued = F.when(F.size(filled) > 0, filled)
        named = raw.select(*values, rescued.alias(RESCUED), PARSE_ERROR, RAW_LINE)
        hashed = [c for c in version.columns if c in found]
        loaded = add_ingestion_metadata(named, self.source_system, self.load_id, self.ingested_at, hashed)
        status = F.when(F.col(PARSE_ERROR).isNull(), "ok").otherwise("malformed")
        return loaded.withColumns({VERSION: F.lit(version.number), STATUS: status})


def ingest_drifting(
    spark: SparkSession, landing: str, root: str, checkpoint: str, feed: DriftingFeed, pattern: str = "*.csv", files_per_trigger: int = 1000, available_now: bool = True
) -> StreamingQuery:
    """Take up new files below ``landing``, each once, whatever columns they have; see ``DriftingFeed``.

    The driver reads one line of each file of a batch; rows are read by the executors, once.
    """
    files = spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", pattern)
    files = files.option("maxFilesPerTrigger", files_per_trigger).load(landing)
    writer = files.select("path").writeStream.foreachBatch(lambda batch, batch_id: feed.take(batch, batch_id, root))
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_drifted(spark: SparkSession, root: str, broken: bool = False) -> DataFrame:
    """What has been ingested, in the columns of the newest schema version; with ``broken``, the lines kept apart."""
    columns = string_schema(SchemaLog(spark, root).latest().columns)
    schema = T.StructType([*columns.fields, T.StructField(RESCUED, T.MapType(T.StringType(), T.StringType()))])
    for part in (f"{PARSE_ERROR} string, {RAW_LINE} string", LINEAGE, f"{VERSION} int"):
        schema = T.StructType([*schema.fields, *T.StructType.fromDDL(part).fields])
    rows = spark.read.schema(schema).parquet(f"{root}/raw").where(F.col(STATUS) == ("malformed" if broken else "ok")).drop(STATUS, "batch_id")
    return rows if broken else rows.drop(PARSE_ERROR, RAW_LINE)
