"""Vector codes: parts of vectors replaced by their nearest codebook entries, found by Orchard's search."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import stage, table
from tallyline.operators.skew import skew_join

PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Vectors that are coded together inside a task.
CHUNK = 2048
#: Components stop here on either side, so that sums of a trillion rows fit a decimal.
LARGEST = 2.0**86
#: Below this, squared distances are exact as 64-bit integers for parts of up to 2**15 components.
SMALL = 2**23
LONG = 2**63 - 1
#: So many label sums at most are broadcast, some 10 MB; more are joined with hot labels spread.
MOST_BROADCAST = 100_000


@dataclass(frozen=True)
class Codebooks:
    """Entries of each part, ``books[part][entry][position]``, with what Orchard's search needs."""

    books: np.ndarray

    def __post_init__(self):
        entries = self.books
        squares = _exact(entries, entries)[0]
        apart = np.stack([((b[:, None] - b[None]) ** 2).sum(-1) for b in squares])
        # for every entry the others by distance, the lower index first among equals
        order = np.argsort(apart, axis=-1, kind="stable")
        n = entries.shape[1]
        others = order[order != np.arange(n)[:, None]].reshape(len(entries), n, n - 1)
        object.__setattr__(self, "lists", others)
        object.__setattr__(self, "apart", np.take_along_axis(apart, others, -1))

    @property
    def dim(self) -> int:
        return self.books.shape[0] * self.books.shape[2]

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for x in self.books.reshape(-1)).encode()).hexdigest()


def _exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """Whole numbers as 64-bit integers where squares of their differences fit, else as Python integers."""
    small = all(a.dtype != object and np.abs(a).max(initial=0) < SMALL for a in arrays)
    if small:
        return [a.astype(np.int64) for a in arrays]
    return [np.frompyfunc(int, 1, 1)(a).astype(object) for a in arrays]


def orchard(parts: np.ndarray, codebooks: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of every part of every vector and its squared distance, ties to the lower index.

    ``parts[vector][part][position]``. A search stands at an entry and walks that entry's list of the
    others, nearest first. It jumps to the list of an entry that is nearer to the part, computes no
    distance twice, and ends where the list is beyond twice its distance: by the triangle inequality
    nothing there can be nearer. All searches of a chunk take their steps together.
    """
    x, books = _exact(parts, codebooks.books)
    n, m, _ = x.shape
    k = books.shape[1]
    part = np.tile(np.arange(m), n)
    x = x.reshape(n * m, -1)

    # it starts at the entry next to the part by first component
    now = np.zeros(n * m, np.int64)
    for p in range(m):
        firsts = books[p, :, 0]
        order = np.argsort(firsts, kind="stable")
        now[p::m] = order[np.minimum(np.searchsorted(firsts[order], x[p::m, 0]), k - 1)]
    least = ((x - books[part, now]) ** 2).sum(-1)
    place = np.zeros(n * m, np.int64)
    marked = np.zeros((n * m, k), bool)
    marked[np.arange(n * m), now] = True
    walking = np.arange(n * m) if k > 1 else np.empty(0, np.int64)
    while len(walking):
        at = part[walking], now[walking], place[walking]
        near = (codebooks.apart[at] <= 4 * least[walking]).astype(bool)
        walking, entry = walking[near], codebooks.lists[at][near]
        fresh = ~marked[walking, entry]
        own, entry = walking[fresh], entry[fresh]
        marked[own, entry] = True
        found = ((x[own] - books[part[own], entry]) ** 2).sum(-1)
        better = ((found < least[own]) | ((found == least[own]) & (entry < now[own]))).astype(bool)
        place[walking] += 1
        own, entry = own[better], entry[better]
        now[own], least[own], place[own] = entry, found[better], 0
        walking = walking[place[walking] < k - 1]
    return now.reshape(n, m), least.reshape(n, m)


def _vectors(rows: DataFrame, vector_id: str, vector: str, label: str, parts: int, scale: int) -> DataFrame:
    """``vec_id, label, v`` of the rows that take part, v as whole numbers held in doubles."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.col(vector).isNotNull() & finite & (F.size(vector) > 0) & (F.size(vector) % parts == 0)

    def component(x):
        scaled = x.cast("double") * scale
        # floor() gives a long; a double beyond its range is whole already
        floored = F.when(F.abs(scaled) < 9e18, F.floor(scaled).cast("double")).otherwise(scaled)
        return F.greatest(F.least(floored, F.lit(LARGEST)), F.lit(-LARGEST))

    return rows.where(whole).select(
        F.col(vector_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.transform(vector, component).alias("v")
    )


def _chunks(batch: pa.RecordBatch, parts: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for start in range(0, batch.num_rows, CHUNK):
        rows = batch.slice(start, CHUNK)
        flat = np.asarray(rows.column(rows.num_columns - 1).flatten())
        yield rows, flat.reshape(rows.num_rows, parts, -1)


def _sums(vectors: DataFrame, codebooks: Codebooks) -> DataFrame:
    """``part, entry, position, n, total`` of the parts nearest to each entry; a task hands on its sums only."""
    shared = vectors.sparkSession.sparkContext.broadcast(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        m, k, width = books.books.shape
        count, total = np.zeros((m, k), np.int64), np.zeros((m, k, width), object)
        for batch in batches:
            for _, parts in _chunks(batch, m):
                nearest, _ = orchard(parts, books)
                whole = _exact(parts)[0]
                for p in range(m):
                    part = np.zeros((k, width), whole.dtype)
                    np.add.at(part, nearest[:, p], whole[:, p])
                    total[p] += part
                    count[p] += np.bincount(nearest[:, p], minlength=k)
        p, e, w = (x.reshape(-1) for x in np.indices((m, k, width)))
        used = count[p, e] > 0
        columns = [pa.array(x[used].astype(np.int32)) for x in (p, e, w)]
        sums = pa.array([str(int(x)) for x in total.reshape(-1)[used]], pa.string())
        yield pa.RecordBatch.from_arrays([*columns, pa.array(count[p, e][used]), sums], names=["part", "entry", "position", "n", "total"])

    found = vectors.select("v").mapInArrow(run, "part int, entry int, position int, n long, total string")
    return found.groupBy("part", "entry", "position").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of ``vec_id, v``: the parts of the smallest ids, moved to their means ``rounds`` times.

    None without a vector. The driver holds the codebooks only, ``entries`` vectors.
    """
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    if not first:
        return None
    dim = len(first[0].v)
    vectors = vectors.where(F.size("v") == dim)
    if any(len(r.v) != dim for r in first):
        first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    books = np.array([r.v for r in first]).reshape(len(first), parts, -1).swapaxes(0, 1)
    books = np.frompyfunc(int, 1, 1)(books).astype(object)
    for _ in range(rounds):
        moved = books.copy()
        for r in _sums(vectors, _books(books)).collect():
            moved[r.part, r.entry, r.position] = int(r.total) // r.n
        books = moved
    return _books(books)


def _books(books: np.ndarray) -> Codebooks:
    small = max((abs(x) for x in books.reshape(-1)), default=0) < SMALL
    return Codebooks(books.astype(np.int64) if small else books)


def vector_codes(
    rows: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    vector_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = 256,
) -> tuple[DataFrame, Codebooks | None]:
    """``vec_id, label, code, error, label_error`` of every usable row, and the codebooks.

    Components become floor(scale * x) and stop at 2**86 on either side. Rows whose vector is null, holds a
    null or non-finite component, or cannot be cut into ``parts`` equal parts, take no part; nor do vectors
    of another length than that of the smallest id. Repeated rows each count and each get a code. Null ids
    come last among the ids and stay null; null labels are one group. Errors beyond a long stop at its end.
    An empty table gives an empty result and no codebooks. With fewer vectors than ``entries`` the
    codebooks are as small.
    """
    if entries > 256:
        raise ValueError("a code has two hexadecimal digits a part, for at most 256 entries")
    vectors = _vectors(rows, vector_id, vector, label, parts, scale)
    codebooks = train(vectors, parts, entries, rounds)
    spark = rows.sparkSession
    schema = "vec_id long, code string, error long"
    dim = 0 if codebooks is None else codebooks.dim
    shared = spark.sparkContext.broadcast(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, x in _chunks(batch, parts):
                nearest, squares = orchard(x, shared.value)
                digits = nearest.astype(np.uint8).tobytes().hex()
                codes = [digits[i : i + 2 * parts] for i in range(0, len(digits), 2 * parts)]
                error = [min(int(e), LONG) for e in squares.sum(1)]
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), own.column(1), pa.array(codes, pa.string()), pa.array(error, pa.int64())],
                    names=["vec_id", "label", "code", "error"],
                )

    fits = vectors.where(F.size("v") == dim)
    kind = vectors.schema["label"].dataType.simpleString()
    coded = stage(fits.mapInArrow(run, schema.replace("code", f"label {kind}, code", 1)), "codes")
    # nulls meet under a key of their own
    keyed = coded.withColumn("label_key", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")))
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    totals = stage(keyed.groupBy("label_key").agg(F.least(total, F.lit(LONG)).cast("long").alias("label_error")), "label_errors")
    if totals.count() <= MOST_BROADCAST:
        found = keyed.join(F.broadcast(totals), "label_key")
    else:
        found = skew_join(keyed, totals, ["label_key"])
    return found.select("vec_id", "label", "code", "error", "label_error"), codebooks


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen-byte codes of all embeddings with their errors, error sums by label and the codebooks' digest."""
    found, codebooks = vector_codes(table(spark, sf_dir, "embeddings"))
    digest = "" if codebooks is None else codebooks.digest()
    return found.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _round_sql(n: int) -> str:
    """Assignment to the entries of round ``n`` and, from it, the entries of the next one."""
    return f"""
    near{n} AS (
        SELECT rid, p, e, dist FROM (
            SELECT x.rid, x.p, b.e, list_sum(list_transform(list_zip(x.part, b.entry), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS dist
            FROM x JOIN book{n} b USING (p)
        ) QUALIFY row_number() OVER (PARTITION BY rid, p ORDER BY dist, e) = 1
    ), mean{n} AS (
        SELECT p, e, list(m ORDER BY i) AS entry FROM (
            SELECT p, e, i, floor(sum(part[i])::DOUBLE / count(*))::BIGINT AS m
            FROM near{n} JOIN x USING (rid, p), generate_series(1, (SELECT max(len(part)) FROM x)) g(i) GROUP BY ALL
        ) GROUP BY ALL
    ), book{n + 1} AS (
        SELECT b.p, b.e, coalesce(m.entry, b.entry) AS entry FROM book{n} b LEFT JOIN mean{n} m USING (p, e)
    )"""


OP13_SQL = f"""
WITH v AS (
    SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), x AS (
    SELECT rid, p, v[p * len(v) // {PARTS} + 1 : (p + 1) * len(v) // {PARTS}] AS part FROM v, generate_series(0, {PARTS - 1}) s(p)
), book0 AS (
    SELECT p, rid - 1 AS e, part AS entry FROM x WHERE rid <= {ENTRIES}
), {", ".join(_round_sql(n) for n in range(ROUNDS + 1))}, coded AS (
    SELECT rid, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(dist)::BIGINT AS error FROM near{ROUNDS} GROUP BY rid
), digest AS (
    SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{ROUNDS}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN v USING (rid), digest
"""
