"""Embedding near-duplicates by an exact metric range join."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import components, stage, table

THRESHOLD = 0.93
#: Vectors a cell should have as its own; labels above it get pivots, one for each so many vectors.
CELL = 4096
#: Pivots of all labels together stay near this number; beyond it cells grow and are cut into chunks.
MAX_PIVOTS = 4096
#: Rows of a cell compared in one task, on either side.
CHUNK = 4096
#: Widening of metric bounds against rounding; candidates are compared exactly afterwards.
EPSILON = 1e-9


def _classes(rows: DataFrame, vector_id: str, vector: str, label: str) -> tuple[DataFrame, DataFrame]:
    """Usable rows with their class of equal vectors, and one row per class: ``rep, label, v, copies``."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists(vector, lambda x: x != 0)
    usable = rows.where(F.col(label).isNotNull() & F.col(vector_id).isNotNull() & F.col(vector).isNotNull() & finite & nonzero)
    usable = usable.select(
        F.col(vector_id).cast("long").alias("vec_id"),
        F.col(label).cast("string").alias("label"),
        F.transform(vector, lambda x: x.cast("double")).alias("v"),
    )
    reps = usable.groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    reps = stage(reps, "classes")
    members = usable.join(reps, ["label", "v"]).select("vec_id", "rep", "copies")
    return members, reps


def _unit(vectors: list[list[float]]) -> np.ndarray:
    m = np.array(vectors, float)
    m /= np.abs(m).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return m / np.sqrt((m * m).sum(1, keepdims=True))


def _pivots(reps: DataFrame, cell: int, most: int) -> dict[tuple[str, int], np.ndarray]:
    """Unit pivots of each label and dimension with more than ``cell`` vectors, chosen by hash."""
    sizes = reps.groupBy("label", F.size("v").alias("dim")).agg(F.count("*").alias("n"))
    cell = max(cell, -(-reps.count() // most))
    large = sizes.where(F.col("n") > cell)
    draw = F.pmod(F.xxhash64("v", F.lit(5)), F.lit(1 << 30))
    chosen = reps.withColumn("dim", F.size("v")).join(F.broadcast(large), ["label", "dim"])
    chosen = chosen.where(draw * F.col("n") < F.lit(float(1 << 30)) * F.ceil(F.col("n") / cell))
    by: dict[tuple[str, int], list] = {}
    for r in chosen.select("label", "dim", "v", "rep").orderBy("label", "dim", "rep").collect():
        by.setdefault((r["label"], r["dim"]), []).append(r["v"])
    return {key: _unit(x) for key, x in by.items()}


def _deal(reps: DataFrame, pivots: dict[tuple[str, int], np.ndarray], radius: float) -> DataFrame:
    """Every class in its home cell and, as a visitor, in each cell with a home vector it could reach.

    A vector v within ``radius`` of a home vector u of cell i has d(v, p_i) <= d(v, p_home) + 2 radius by
    the triangle inequality, as u is nearer to p_i than to v's pivot; in Euclidean space v then also lies
    within ``radius`` of the half space of points nearer to p_i.
    """
    shared = reps.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, vectors = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            index: dict[tuple[str, int], list[int]] = {}
            for i, (x, v) in enumerate(zip(labels, vectors, strict=True)):
                index.setdefault((x, len(v)), []).append(i)
            for (label, dim), own in index.items():
                own = np.array(own)
                p = shared.value.get((label, dim))
                if p is None or not len(p):
                    row, cell, home = own, np.zeros(len(own), int), np.ones(len(own), bool)
                else:
                    u = _unit([vectors[i] for i in own])
                    d = np.sqrt(np.maximum(2 - 2 * u @ p.T, 0))
                    nearest = d.argmin(1)
                    least = d[np.arange(len(d)), nearest][:, None]
                    apart = np.sqrt(np.maximum(2 - 2 * p @ p.T, 0))[nearest]
                    reach = d <= least + 2 * radius + EPSILON
                    reach &= d**2 - least**2 <= 2 * apart * radius + EPSILON
                    reach[np.arange(len(d)), nearest] = True
                    at, cell = np.nonzero(reach)
                    row, home = own[at], nearest[at] == cell
                part = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([dim] * len(row), pa.int32()), pa.array(cell.astype(np.int32)), pa.array(home)],
                    names=["rep", "label", "v", "copies", "dim", "cell", "home"],
                )

    schema = "rep long, label string, v array<double>, copies long, dim int, cell int, home boolean"
    return reps.select("rep", "label", "v", "copies").mapInArrow(run, schema)


def _groups_in(links: np.ndarray, home_at: np.ndarray) -> np.ndarray:
    """Group number of each member, -1 for members without a link. ``links``: home rows by members."""
    group = np.full(links.shape[1], -1)
    home_of = np.full(links.shape[1], -1)
    home_of[home_at] = np.arange(len(home_at))
    seen, n = np.zeros(len(home_at), bool), 0
    for start in range(len(home_at)):
        if seen[start] or not links[start].any():
            continue
        frontier, reached = np.array([start]), np.zeros(links.shape[1], bool)
        seen[start] = True
        while len(frontier):
            reached |= links[frontier].any(0)
            reached[home_at[frontier]] = True
            # homes among the reached, and homes linked to a reached member
            frontier = np.flatnonzero(~seen & (links[:, reached].any(1) | np.isin(np.arange(len(home_at)), home_of[reached])))
            seen[frontier] = True
        group[reached] = n
        n += 1
    return group


def _compare(cell: pa.Table, threshold: float) -> pa.RecordBatch:
    """Links inside one task: for each home row its weighted number of links, and edges to its group's least.

    ``side`` is 0 for the chunk of home rows and 1 for the chunk of members they are compared with.
    """
    rep, copies, side = (np.asarray(cell.column(x).combine_chunks()) for x in ("rep", "copies", "side"))
    dim = cell.column("dim")[0].as_py()
    flat = np.concatenate([np.asarray(x.flatten()) for x in cell.column("v").chunks])
    m = flat.reshape(len(rep), dim)
    scale = np.abs(m).max(1, keepdims=True)
    unit = m / scale
    norm = np.sqrt((unit * unit).sum(1))
    home, member = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    links = np.empty((len(home), len(member)), bool)
    for at in range(0, len(home), 512):
        rows = home[at : at + 512]
        cosine = (unit[rows] @ unit[member].T) / (norm[rows][:, None] * norm[member][None, :])
        links[at : at + 512] = (cosine >= threshold) & (rep[rows][:, None] != rep[member][None, :])
    n = links @ copies[member]
    # one node per class: homes that are members too, then the other homes
    nodes, at = np.unique(np.concatenate([rep[member], rep[home]]), return_inverse=True)
    wide = np.zeros((len(home), len(nodes)), bool)
    wide[:, at[: len(member)]] = links
    group = _groups_in(wide, at[len(member) :])
    root = np.full(group.max(initial=-1) + 1, np.iinfo(np.int64).max)
    np.minimum.at(root, group[group >= 0], nodes[group >= 0])
    linked = np.flatnonzero(group >= 0)
    ids = np.concatenate([rep[home], nodes[linked]])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids),
            pa.array(np.concatenate([n, np.zeros(len(linked), np.int64)]).astype(np.int64)),
            pa.array(np.concatenate([rep[home], root[group[linked]]])),
        ],
        names=["rep", "n", "root"],
    )


def near_vectors(
    rows: DataFrame, threshold: float = THRESHOLD, vector_id: str = "vec_id", vector: str = "embedding",
    label: str = "label", cell: int = CELL, chunk: int = CHUNK,
) -> DataFrame:
    """Vectors of one label whose cosine reaches ``threshold``, as links and components.

    Returns a row per input row: ``vec_id, n_links, component_id, kept``. Cosines are in double precision.
    A vector that is null, zero, empty or holds a null or non-finite component, and one with a null label
    or id, links with nothing and is its own component; vectors of different lengths do not link. Equal
    vectors link with each other. Rows that repeat a vec_id count as vectors of their own with one
    component. ``kept`` marks the smallest id of a component. An empty table gives an empty result.

    Equal vectors become one class with a count, so copies are never paired. The classes of a label are
    dealt to cells around pivots; a cell is joined on its own, chunk by chunk, home rows against all rows
    of the cell, and gives back counts and one edge per linked class, never pairs.
    """
    radius = math.sqrt(max(0.0, 2 - 2 * threshold))
    members, reps = _classes(rows, vector_id, vector, label)
    dealt = stage(_deal(reps, _pivots(reps, cell, MAX_PIVOTS), radius), "cells")
    key = ["label", "dim", "cell"]
    sizes = dealt.groupBy(*key).agg(
        F.ceil(F.sum(F.col("home").cast("int")) / chunk).cast("int").alias("homes"), F.ceil(F.count("*") / chunk).cast("int").alias("all")
    )
    dealt = dealt.join(sizes.where("homes > 0"), key)
    place = F.xxhash64("rep")

    def upto(n: str) -> Column:
        return F.sequence(F.lit(0).cast("long"), F.col(n).cast("long") - 1)

    home = dealt.where("home").select(*key, F.pmod(place, "homes").alias("i"), F.explode(upto("all")).alias("j"), F.lit(0).alias("side"), "rep", "copies", "v")
    every = dealt.select(*key, F.explode(upto("homes")).alias("i"), F.pmod(place, "all").alias("j"), F.lit(1).alias("side"), "rep", "copies", "v")

    def run(rows: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_compare(rows, threshold)])

    found = home.union(every).groupBy(*key, "i", "j").applyInArrow(run, "rep long, n long, root long")
    found = stage(found.groupBy("rep", "root").agg(F.sum("n").alias("n")), "links")
    links = found.groupBy("rep").agg(F.sum("n").alias("others"))
    groups = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    ids = members.join(links, "rep", "left").join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    ids = ids.groupBy("vec_id").agg(
        F.max(F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.min(F.coalesce("root", "rep")).alias("component_id")
    )
    out = rows.select(F.col(vector_id).cast("long").alias("vec_id")).join(ids, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors of equal labels with a cosine of at least 0.93."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP9_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93
), reach AS (
    SELECT DISTINCT vec_id AS node, vec_id AS seen FROM embeddings
    UNION
    SELECT r.node, l.b FROM reach r JOIN links l ON r.seen = l.a
), least AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN least c ON c.node = e.vec_id
"""
