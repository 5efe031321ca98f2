"""Joins on any one of several keys, written as equi-joins.

``a.k1 = b.k1 OR a.k2 = b.k2`` gives Spark no key to hash on, so it compares every pair of rows.
Turning each row into one entry per filled key makes it an ordinary hash join on (key number, value).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions import is_blank
from tallyline.operators.dedupe import top_per_key
from tallyline.operators.skew import hot_keys, skew_join


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[prefix + c for c in df.columns])


def filled_sql(column: str) -> str:
    return f"coalesce(trim(CAST(`{column}` AS STRING)), '') <> ''"


def key_entries(df: DataFrame, keys: Sequence[str], ranks: Sequence[int] | None = None) -> DataFrame:
    """One row per filled key: ``_rank``, its place in ``keys``, and ``_value``. Blank keys give no row."""
    ranks = range(len(keys)) if ranks is None else ranks
    entries = ", ".join(
        f"CASE WHEN {filled_sql(k)} THEN struct({r} AS rank, CAST(`{k}` AS STRING) AS value) END"
        for r, k in zip(ranks, keys)
    )
    return df.selectExpr("*", f"inline(array_compact(array({entries}))) AS (_rank, _value)")


def any_key_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    within: Sequence[str] = (),
    left_id: str | None = None,
    how: str = "inner",
) -> DataFrame:
    """Pairs that agree on at least one filled key, and on all ``within`` columns.

    Columns come out as ``l_*`` and ``r_*``. A pair that agrees on several keys is kept only where
    it meets on the first of them, so pairs are unique without a distinct over the result.
    ``how="left"`` keeps unmatched left rows and needs a unique ``left_id``. ``left`` is read more
    than once: pass a stored table, not a long plan.
    """
    lefts, rights = prefixed(left, "l_"), prefixed(right, "r_")
    l_names, r_names = lefts.columns, rights.columns
    for c in within:
        lefts = lefts.where(filled_sql(f"l_{c}")).withColumn(f"_w_{c}", F.col(f"l_{c}"))
        rights = rights.where(filled_sql(f"r_{c}")).withColumn(f"_w_{c}", F.col(f"r_{c}"))
    on = ["_rank", "_value", *[f"_w_{c}" for c in within]]
    lefts, rights = key_entries(lefts, [f"l_{k}" for k in keys]), key_entries(rights, [f"r_{k}" for k in keys])
    # the last key is not looked at, so that neither side carries it along for this
    earlier = " OR ".join(
        f"(_rank > {i} AND coalesce({filled_sql(f'l_{k}')} AND CAST(`l_{k}` AS STRING) = CAST(`r_{k}` AS STRING), false))"
        for i, k in enumerate(keys[:-1])
    )
    crowded = hot_keys(lefts, on)
    pairs = skew_join(lefts, rights, on, hot=crowded, hot_right=True).where(f"NOT ({earlier or 'false'})").select(*l_names, *r_names)
    if how == "inner":
        return pairs
    if left_id is None:
        raise ValueError("a left any_key_join needs left_id")
    # a left row has a partner when one of its keys occurs on the right
    found = skew_join(lefts.select(f"l_{left_id}", *on), rights.select(*on).distinct(), on, "left_semi", hot=crowded)
    alone = prefixed(left, "l_").join(found.select(f"l_{left_id}").distinct(), f"l_{left_id}", "left_anti")
    return pairs.unionByName(alone, allowMissingColumns=True)


def priority_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    payload: Sequence[str],
    unique: Sequence[str] = (),
) -> DataFrame:
    """Every left row with the ``payload`` of one right row: found by the first key, else the next.

    The right side is cut to its first row per key value before each join, so no left row fans out.
    Keys named in ``unique`` are unique on the left and are not looked through for hot values.
    """
    out = left
    for i, key in enumerate(keys):
        lookup = top_per_key(right.where(~is_blank(key)), [key], order).select(
            F.col(key).alias(f"_k{i}"), F.struct(*payload).alias(f"_p{i}")
        )
        filled = F.when(~is_blank(key), F.col(key)).alias(f"_k{i}")
        hot = False if key in unique else hot_keys(left.select(filled), [f"_k{i}"])
        out = skew_join(out.select("*", filled), lookup, [f"_k{i}"], "left", hot=hot).drop(f"_k{i}")
    found = F.coalesce(*[F.col(f"_p{i}") for i in range(len(keys))])
    return out.select(*left.columns, *[found[c].alias(c) for c in payload])


def link_on_keys(left: DataFrame, right: DataFrame, on: Sequence[str], suffix: str = "_right") -> DataFrame:
    """Left join on equal keys; right columns whose name is taken get ``suffix``.

    Matched and unmatched rows are found apart, so that a key may be crowded on either side.
    """
    taken = set(left.columns) - set(on)
    renamed = right.select([F.col(c).alias(c + suffix if c in taken else c) for c in right.columns])
    crowded = hot_keys(left, on)
    matched = skew_join(left, renamed, on, hot=crowded, hot_right=hot_keys(right, on))
    alone = skew_join(left, right.select(*on).distinct(), on, "left_anti", hot=crowded)
    columns = [*left.columns, *[c for c in renamed.columns if c not in on]]
    return matched.unionByName(alone, allowMissingColumns=True).select(*columns)
