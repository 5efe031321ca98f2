"""Joins that keep working when one key holds a large share of the rows.

Adaptive execution splits a skewed sort-merge partition by itself, but not below an operator that
needs the join's partitioning, and rows with a NULL key always meet in one task. ``skew_join``
spreads both kinds of row explicitly.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Counters of a frequent-items sketch for each partition that a hot key must fill (within Spark's limits). A key
# is hot from one partition's share on, the sketch's error is about a quarter of that.
COUNTERS_PER_PARTITION = 16
FEWEST_COUNTERS, MOST_COUNTERS = 1024, 1_000_000


def names_sql(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def _present(columns: Sequence[str]) -> str:
    return " AND ".join(f"`{c}` IS NOT NULL" for c in columns)


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_items(summary: DataFrame, partitions: int) -> DataFrame:
    """(_hot, _parts) from one row with a row count ``_n`` and the most frequent items ``_top``.

    An item is hot when it fills more than an even share of one partition; it is cut into parts of
    about half such a share.
    """
    return (
        summary.selectExpr("_n", "inline(_top) AS (_hot, _seen)")
        .where(f"_seen * {partitions} > _n")
        .selectExpr("_hot", f"greatest(2L, ceil(_seen * {2 * partitions} / _n)) AS _parts")
    )


def hot_keys(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Hashes of the keys too large for one of ``partitions`` tasks, and into how many parts to cut each.

    ``partitions`` is the number of shuffle partitions unless given. At most so many keys can be hot, and
    the list, which is broadcast, has at most so many short rows. One pass over the key columns: each task
    keeps a frequent-items sketch and only the sketches are shuffled. A wrong estimate changes how rows
    are spread, never the join result.
    """
    partitions = partitions or _partitions(df)
    hashes = df.where(_present(keys)).selectExpr(f"xxhash64({names_sql(keys)}) AS _h")
    return hot_items(frequent_items(hashes, "_h", partitions, partitions), partitions)


def frequent_items(df: DataFrame, column: str, most: int, partitions: int) -> DataFrame:
    """One row (none without rows): the row count ``_n`` and ``_top``, up to ``most`` frequent items with estimated counts.

    The sketches of the tasks are merged in two levels, so no reducer takes one from every task.
    """
    most = max(1, min(most, MOST_COUNTERS))
    counters = min(MOST_COUNTERS, max(FEWEST_COUNTERS, COUNTERS_PER_PARTITION * partitions, most))
    groups = math.isqrt(partitions) + 1
    level = df.selectExpr(f"`{column}` AS _item", f"pmod(spark_partition_id(), {groups}) AS _group").groupBy("_group")
    level = level.agg(F.count("*").alias("_n"), F.expr(f"approx_top_k_accumulate(_item, {counters})").alias("_state"))
    # grouped by a constant: without a group, a task without rows would hand on a sketch that cannot be merged
    whole = level.groupBy(F.lit("all")).agg(F.sum("_n").alias("_n"), F.expr(f"approx_top_k_combine(_state, {counters})").alias("_state"))
    return whole.selectExpr("_n", f"approx_top_k_estimate(_state, {most}) AS _top")


# Parts go to tasks by a hash; so many times as many, smaller ones come out even.
FINER = 4
# A row's place within its task after _numbered.
PLACE = "_place"


def _numbered(df: DataFrame, cold: str, names: Sequence[str]) -> DataFrame:
    """Number the rows to be dealt out within their task, so that equal rows part as well.

    Rows are put in the order of their hashes first. Rows with equal hashes are equal, so whatever order a
    task reads its rows in, a rerun gives the same numbers to the same rows and nothing is lost or doubled.
    Rows that are not dealt out (``cold``) come last, and their order does not matter.
    """
    row = ", ".join(names)
    ordered = df.sortWithinPartitions(F.expr(cold), F.expr(f"CASE WHEN {cold} THEN 0L ELSE xxhash64({row}) END"), F.expr(f"CASE WHEN {cold} THEN 0 ELSE hash({row}) END"))
    return ordered.withColumn(PLACE, F.monotonically_increasing_id())


def _dealing(names: Sequence[str]) -> str:
    """The number that deals a row to its part: its place, offset by its hash."""
    return f"(shiftright(xxhash64({', '.join(names)}), 2) + {PLACE})"


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot: DataFrame | bool | None = None,
    hot_right: DataFrame | bool = False,
    hot_on: Sequence[str] | None = None,
) -> DataFrame:
    """``left.join(right, on, how)`` with hot keys; ``how`` keeps or filters left rows.

    Left rows of a hot key are dealt to its parts by a hash of the row and its place among the hot rows
    of its task, so that equal rows part as well, and the right rows of those few keys are copied to each
    part. Left rows with a NULL key match nothing and are dealt out freely. A rerun task sends the same
    rows to the same places (see ``_numbered``). For an inner join with keys that are hot on the right,
    ``hot_right`` (True or a list) cuts that side too.

    ``hot`` and ``hot_right`` may be lists from ``hot_keys`` over ``hot_on``, some of the join
    columns, shared by several joins; otherwise the side is read once more to find them.
    ``hot=False`` is for sides that are unique on ``on`` and only spreads the NULL keys.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"skew_join cannot do a {how} join")
    if hot_right is not False and how != "inner":
        raise ValueError("only an inner join can cut keys that are hot on the right")
    on = list(on)
    hot_on = on if hot_on is None else list(hot_on)
    if hot is None:
        hot = hot_keys(left, hot_on)
    if hot_right is True:
        hot_right = hot_keys(right, hot_on)
    present = _present(on)
    l_names, r_names = [f"`{c}`" for c in left.columns], [f"`{c}`" for c in right.columns]
    if how in ("inner", "left_semi"):
        left = left.where(present)
    right = right.where(present)
    key_hash = f"xxhash64({names_sql(hot_on)})"
    l_salts, r_salts, salts = [], [], []

    def cut(listed: DataFrame, salt: str, dealt_names: list[str], dealt_salts: list[str], copied_salts: list[str]) -> None:
        nonlocal left, right
        parts = f"{salt}_parts"
        listed = F.broadcast(listed.toDF(f"{salt}_hot", parts).withColumn(parts, F.col(parts) * FINER))
        condition = F.expr(f"{key_hash} = {salt}_hot")
        left, right = left.join(listed, condition, "left"), right.join(listed, condition, "left")
        dealt_salts.append(f"CASE WHEN {parts} IS NULL THEN 0L ELSE pmod({_dealing(dealt_names)}, {parts}) END AS {salt}")
        copied_salts.append(f"explode(sequence(0L, coalesce({parts}, 1L) - 1L)) AS {salt}")
        salts.append(salt)

    if hot is not False:
        cut(hot, "_salt", l_names, l_salts, r_salts)
        spread_nulls = "" if how in ("inner", "left_semi") else f" AND {present}"
        left = _numbered(left, f"_salt_parts IS NULL{spread_nulls}", l_names)
    if hot_right is not False:
        cut(hot_right, "_rsalt", r_names, r_salts, l_salts)
        right = _numbered(right, "_rsalt_parts IS NULL", r_names)
    if how in ("left", "left_anti"):
        # rows without a key never match: any salt will do, and they need not meet
        dealing = f"xxhash64({', '.join(l_names)})" if hot is False else _dealing(l_names)
        free = f"CASE WHEN {present} THEN 0L ELSE pmod({dealing}, 65536L) END AS _spread"
        # a plain 0 here would be folded into the condition, and the salt would no longer part the rows
        zero = f"pmod(xxhash64({names_sql(on)}), 1L) AS _spread"
        l_salts, r_salts, salts = [*l_salts, free], [*r_salts, zero], [*salts, "_spread"]
    left, right = left.selectExpr(*l_names, *l_salts), right.selectExpr(*r_names, *r_salts)
    return left.join(right, [*on, *salts], how).drop(*salts)
