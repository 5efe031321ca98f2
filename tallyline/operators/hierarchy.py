"""Totals over a hierarchy of any depth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.sources import staged


def roll_up(values: DataFrame, parents: DataFrame, max_depth: int = 64) -> DataFrame:
    """Totals of every node over itself and all nodes below it.

    ``values`` has ``node, amount`` (any number of rows per node), ``parents`` has ``node, parent``; a node
    without a row or with a NULL parent is a root. Returns ``node, amount, members``: the sum as
    decimal(38,2) and the number of nodes with values that it covers. Each level is one join of what is
    left to lift, already added up per node, so a parent of very many children receives one row per
    child and level, summed in the tasks before the shuffle. Raises ValueError when a path is longer than
    ``max_depth``, as with a cycle.
    """
    links = parents.where("node IS NOT NULL AND parent IS NOT NULL").select("node", "parent")
    own = values.where("node IS NOT NULL").groupBy("node").agg(F.sum(F.col("amount").cast("decimal(38,2)")).alias("amount"))
    level = staged(own.select("node", "amount", F.lit(1).cast("long").alias("members")), "level")
    levels = level
    for _ in range(max_depth):
        lifted = level.join(links, "node").groupBy(F.col("parent").alias("node"))
        lifted = lifted.agg(F.sum("amount").cast("decimal(38,2)").alias("amount"), F.sum("members").alias("members"))
        level = staged(lifted, "level")
        if level.isEmpty():
            return levels.groupBy("node").agg(F.sum("amount").cast("decimal(38,2)").alias("amount"), F.sum("members").alias("members"))
        levels = levels.union(level)
    raise ValueError(f"a path in the hierarchy is longer than {max_depth}")
