"""Exact top-k search by block-at-a-time pruning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm.common import packed, parts, stage, table, unpacked

#: Vectors in a block, blocks scored by one task, and queries that meet them there.
BLOCK = 256
BLOCKS_PER_TASK = 32
QUERIES_PER_TASK = 2048
#: Above this, products are summed as Python integers: double precision is exact below 2**53.
EXACT = 2.0**53


def _vectors(rows: DataFrame, vector_id: str, vector: str, scale: int) -> DataFrame:
    """``vec_id, v`` of the rows that take part, v as integers floor(scale * x) held in doubles."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = rows.where(F.col(vector_id).isNotNull() & F.col(vector).isNotNull() & finite)
    scaled = F.transform(vector, lambda x: x.cast("double") * scale)
    # floor() gives a long; a double beyond its range is whole already
    v = F.transform(scaled, lambda x: F.when(F.abs(x) < 9e18, F.floor(x).cast("double")).otherwise(x))
    return usable.select(F.col(vector_id).cast("long").alias("vec_id"), v.alias("v"))


def _pack(rows: DataFrame, size: int) -> DataFrame:
    """Rows in vec_id order as blocks of ``size``: ``dim, payload``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[int, list[float]]]] = {}

        def block(dim: int) -> pa.RecordBatch:
            ids, vectors = zip(*waiting.pop(dim), strict=True)
            flat = pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate(vectors) if dim else np.empty(0)), max(dim, 1)) if dim else None
            columns = {"id": pa.array(ids, pa.int64())} | ({"v": flat} if dim else {})
            return pa.RecordBatch.from_arrays([pa.array([dim]), pa.array([packed(pa.table(columns).combine_chunks().to_batches()[0])])], names=["dim", "payload"])

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = waiting.setdefault(len(v), [])
                own.append((i, np.asarray(v.values)))
                if len(own) == size:
                    yield block(len(v))
        for dim in list(waiting):
            yield block(dim)

    return rows.mapInArrow(run, "dim long, payload binary")


def _matrix(payload: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    rows = unpacked(payload)
    ids = np.asarray(rows.column("id"))
    return ids, np.asarray(rows.column("v").combine_chunks().flatten()).reshape(len(ids), dim) if dim else np.empty((len(ids), 0))


def _merge(score: np.ndarray, ident: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row, higher score first and smaller id among equals; id -1 marks an empty place."""
    order = np.lexsort((ident, -score), axis=1)[:, :k]
    return np.take_along_axis(score, order, 1), np.take_along_axis(ident, order, 1)


def _best(q_ids: np.ndarray, q: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Top k of the blocks for each query: blocks by falling bound, until a bound is below the kth score."""
    high = np.stack([v.max(0) for _, v in blocks])
    low = np.stack([v.min(0) for _, v in blocks])
    bound = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    order = np.argsort(-bound, axis=1, kind="stable")
    score, ident = np.full((len(q), k), -np.inf), np.full((len(q), k), -1, np.int64)
    alive = np.arange(len(q))
    for step in range(len(blocks)):
        alive = alive[bound[alive, order[alive, step]] >= score[alive, -1]]
        if not len(alive):
            break
        turn = order[alive, step]
        for b in np.unique(turn):
            own = alive[turn == b]
            ids, v = blocks[b]
            got = q[own] @ v.T
            got[q_ids[own][:, None] == ids[None, :]] = -np.inf
            top = min(len(ids), k)
            if len(ids) > 4 * k:  # rows that can still enter: no worse than the kth of this block or so far
                kth = np.maximum(np.partition(got, -top, axis=1)[:, -top], score[own, -1])
                hit_q, hit_v = np.nonzero((got >= kth[:, None]) & np.isfinite(got))
                width = int(np.bincount(hit_q, minlength=1).max(initial=0))
                new, who = np.full((len(own), width), -np.inf), np.full((len(own), width), -1, np.int64)
                place = np.arange(len(hit_q)) - np.searchsorted(hit_q, hit_q)
                new[hit_q, place], who[hit_q, place] = got[hit_q, hit_v], ids[hit_v]
            else:
                new, who = got, np.where(np.isfinite(got), ids[None, :], -1)
            score[own], ident[own] = _merge(np.hstack([score[own], new]), np.hstack([ident[own], who]), k)
    return score, ident


def _exact(q_ids: np.ndarray, q: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[list[tuple[int, int]]]:
    """The same for values too large for double precision, in Python integers."""
    rows = [(int(i), [int(x) for x in v]) for ids, m in blocks for i, v in zip(ids, m, strict=True)]
    out = []
    for own, v in zip(q_ids, q, strict=True):
        mine = [int(x) for x in v]
        found = ((sum(a * b for a, b in zip(mine, w, strict=True)), i) for i, w in rows if i != own)
        scored = [(-max(min(s, 2**63 - 1), -(2**63)), i) for s, i in found]
        out.append([(-s, i) for s, i in sorted(scored)[:k]])
    return out


def _search_task(payloads: list[bytes], queries: list[bytes], dim: int, k: int) -> Iterator[pa.RecordBatch]:
    blocks = [_matrix(x, dim) for x in payloads]
    for payload in queries:
        q_ids, q = _matrix(payload, dim)
        most = max((np.abs(v).max(initial=0) for _, v in blocks), default=0) * np.abs(q).max(initial=0) * max(dim, 1)
        if most < EXACT:
            score, ident = _best(q_ids, q, blocks, k)
            at = np.nonzero(np.isfinite(score))
            found = q_ids[at[0]], ident[at], score[at].astype(np.int64)
        else:
            rows = [(q_ids[n], i, s) for n, x in enumerate(_exact(q_ids, q, blocks, k)) for s, i in x]
            found = tuple(zip(*rows, strict=True)) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["query_id", "vec_id", "score"])


def top_k(
    rows: DataFrame, is_query: Column, k: int = 5, vector_id: str = "vec_id", vector: str = "embedding", scale: int = 256
) -> DataFrame:
    """The ``k`` highest integer inner products of every query row with all other rows.

    Components become floor(scale * x). Returns ``query_id, rank, vec_id, score``, ranks from 1, ties to
    the smaller vec_id; all rows if there are fewer. Rows with a null id, a null vector or a null or
    non-finite component take no part; a query meets only vectors of its own length. A row with the
    query's id is never its candidate; repeated candidate rows count once. Scores beyond a long stop at
    its ends. An empty table gives an empty result.

    Rows in id order form blocks with their own forward index (the matrix) and maxima and minima of each
    term. Groups of blocks meet groups of queries on a grid of fixed cell sizes, so that no task holds
    more than one cell, and each cell orders its blocks by the queries' summed maxima.
    """
    spark = rows.sparkSession
    clean = _vectors(rows.withColumn("_q", F.coalesce(is_query, F.lit(False))), vector_id, vector, scale)
    kept = stage(clean.distinct(), "vectors")
    marks = rows.where(F.coalesce(is_query, F.lit(False))).select(F.col(vector_id).cast("long").alias("vec_id")).distinct()
    n = parts(spark)
    blocks = stage(_pack(kept.repartitionByRange(n, "vec_id").sortWithinPartitions("vec_id"), BLOCK), "blocks")
    asked = stage(_pack(kept.join(marks, "vec_id", "left_semi").repartition(max(1, n // 4), "vec_id"), BLOCK), "asked")

    def dealt(df: DataFrame, each: int) -> tuple[DataFrame, int]:
        """A group number for every block: blocks per group on average ``each``, by a hash of the block."""
        groups = max(1, -(-df.count() // each))
        return df.withColumn("group", F.pmod(F.xxhash64("payload"), F.lit(groups)).cast("int")), groups

    (blocks, rows_of), (asked, columns_of) = dealt(blocks, BLOCKS_PER_TASK), dealt(asked, max(1, QUERIES_PER_TASK // BLOCK))
    left = blocks.select("dim", F.col("group").alias("g"), F.explode(F.sequence(F.lit(0), F.lit(columns_of - 1))).alias("h"), F.lit(0).alias("kind"), "payload")
    right = asked.select("dim", F.explode(F.sequence(F.lit(0), F.lit(rows_of - 1))).alias("g"), F.col("group").alias("h"), F.lit(1).alias("kind"), "payload")

    def run(cell: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: tuple[list[bytes], list[bytes]] = ([], [])
        dim = 0
        for batch in cell:
            dim = batch.column(0)[0].as_py()
            for kind, payload in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                got[kind].append(payload)
        if got[0] and got[1]:
            yield from _search_task(*got, dim, k)

    found = left.union(right).groupBy("dim", "g", "h").applyInArrow(run, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every vector whose id is divisible by 50, among all other vectors."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP4_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""
