"""Helpers that several operators share: reading, staging, Arrow payloads and linked groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.sources import shared_dir

#: A word is a maximal run of characters other than space and the controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, purpose: str, compression: str = "zstd") -> DataFrame:
    """Store a derived table in the shared folder and read it back, so that lost executors cost no recomputation."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession) -> int:
    """How many parts packed data are dealt to: the session's number of shuffle partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def word_count(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def packed(batch: pa.RecordBatch, level: int = 1) -> bytes:
    """Rows as one compressed Arrow stream, which shuffles as a single value."""
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=level))
    with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
        out.write(batch)
    return sink.getvalue().to_pybytes()


def unpacked(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def dealt(batch: pa.RecordBatch, bucket: np.ndarray, kind: int, level: int = 1) -> pa.RecordBatch:
    """Rows packed by bucket: ``bucket, kind, payload``."""
    order = np.argsort(bucket, kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    ends = np.append(first[1:], len(order))
    rows = batch.take(pa.array(order))
    payloads = [packed(rows.slice(a, b - a), level) for a, b in zip(first, ends, strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array(found.astype(np.int64)), pa.array([kind] * len(found), pa.int32()), pa.array(payloads, pa.binary())],
        names=["bucket", "kind", "payload"],
    )


#: Schema of packed rows.
DEALT = "bucket long, kind int, payload binary"


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after another, and the number of words of each text; null texts have none."""
    trimmed = pc.ascii_trim_whitespace(texts.fill_null("").cast(pa.large_string()))
    split = pc.ascii_split_whitespace(trimmed)
    counts = np.diff(np.asarray(split.offsets))
    words = split.flatten()
    blank = np.asarray(pc.binary_length(trimmed)) == 0  # an empty text splits into one empty word
    if blank.any():
        words = words.filter(pc.greater(pc.binary_length(words), 0))
        counts = np.where(blank, 0, counts)
    return words, counts


def slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in ranges of rows whose texts add up to about ``most`` bytes; a larger text comes alone."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
    start, total = 0, 0
    for k, x in enumerate(sizes.tolist()):
        if k > start and total + x > most:
            yield batch.slice(start, k - start)
            start, total = k, 0
        total += x
    if start < batch.num_rows:
        yield batch.slice(start)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components by alternating large-star and small-star rounds.

    Returns ``node, root`` for every node of an edge; the root is the component's smallest node. Each
    round is a grouped minimum and two joins, staged in the shared folder; it deals the edges out three times. It ends
    when every edge leads straight to a root, which one grouped pass finds out; only its count reaches the driver.
    """
    now = stage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct(), "edges")
    while not _are_stars(now):
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # dealt by u once, for the distinct, the minimum and the join
        large = large.repartition("u").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        now = stage(small.where("u != v"), "stars")
    leaves, roots = now.select(F.col("u").alias("node"), F.col("v").alias("root")), now.select(F.col("v").alias("node"), F.col("v").alias("root"))
    return leaves.union(roots).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node with a smaller neighbour has one only, and no larger ones."""
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("down"))
    ends = ends.union(edges.select(F.col("v").alias("node"), F.lit(None).cast("long").alias("down")))
    seen = ends.groupBy("node").agg(F.min("down").alias("low"), F.max("down").alias("high"), F.max(F.col("down").isNull()).alias("up"))
    return not seen.where("low < high or (low is not null and up)").agg(F.count("*")).first()[0]
