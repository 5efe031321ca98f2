"""Mixing sources to target weights, in DataFrame functions only."""

from __future__ import annotations

from math import lcm

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm.common import stage, table, word_count

#: Key ranges per source. A source's prefix sums run over its ranges first and inside a range after.
RANGES_HEX = 3


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3) -> DataFrame:
    """``source, size`` to one row per source: ``source, source_size, target``.

    Sources in code point order, null last, take the weights in turn. The targets share the sum of all
    sizes by weight; a target stops at ``max_epochs`` times its source's size and the excess goes to the
    others by weight until none is above. That level is found in one pass: sources sorted by the level at
    which they fill up are full as long as the level left for the rest reaches theirs.
    """
    common = lcm(*weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("place", F.row_number().over(by_name) - 1).withColumn("w", weight.cast("long"))
    per = per.withColumn("cap", F.col("source_size") * max_epochs)
    order = Window.orderBy(F.col("cap") * F.lit(common) / F.col("w"), "place")
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = (
        per.withColumn("before", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("w_left", F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("total", F.sum("source_size").over(whole))
        .withColumn("full", F.col("cap") * F.col("w_left") <= (F.col("total") - F.col("before")) * F.col("w"))
        .withColumn("left", F.col("total") - F.coalesce(F.sum(F.expr("if(full, cap, 0)")).over(whole), F.lit(0)))
        .withColumn("w_open", F.sum(F.expr("if(full, 0, w)")).over(whole))
    )
    target = F.expr("if(full, cast(cap as double), cast(left * w as double) / w_open)")
    return per.select("source", "source_size", target.alias("target"))


def mix(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3) -> DataFrame:
    """How often each document enters a mix of the sources by weight.

    ``sized`` has ``doc_id, source, size``; other columns are left out. The result has one row per input
    row: ``doc_id, source, size, source_size, target, epochs, part, taken``. A source gives its rounded
    target in whole passes (``epochs``) and one last pass that follows the hash-random keys and is cut
    where the budget ends: ``part`` is what the last pass takes of a document, which is its whole size
    except for the one document at the cut. ``taken = epochs * size + part``.

    The keys are hashes of doc_id, so reruns agree; equal keys go by doc_id and size, and rows equal in
    all three are interchangeable. Null doc_ids sort first, null sources are a source of their own, null
    or empty texts have size 0 and take nothing. An empty table gives an empty result.

    The running sums are distributed: the key space is cut into ranges, sums per source and range are
    accumulated over the ranges, and each range adds its own running sum. A source with a third of all
    rows is therefore spread over all its ranges.
    """
    keyed = sized.select(
        "doc_id", "source", "size", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("key")
    ).withColumn("span", F.substring("key", 1, RANGES_HEX))
    flat = [F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNull().alias("none")]
    spans = keyed.groupBy(*flat, "span").agg(F.sum("size").alias("sum"))
    along = Window.partitionBy("s", "none").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("ahead", F.coalesce(F.sum("sum").over(along), F.lit(0))).drop("sum")
    targets = source_targets(sized.select("source", "size"), weights, max_epochs)
    budget = F.floor(F.col("target") + 0.5).cast("long")
    targets = (
        targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("div(cast(floor(target + 0.5) as bigint), source_size)")).otherwise(0).cast("long"))
        .withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
        .select(*flat, "source_size", "target", "epochs", "rest")
    )
    inside = Window.partitionBy("s", "none", "span").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = keyed.select("*", *flat).withColumn("own", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(spans.join(targets, ["s", "none"]), ["s", "none", "span"])
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("ahead") - F.col("own"))).cast("long")
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", "epochs", part.alias("part"),
        (F.col("epochs") * F.col("size") + part).alias("taken"),
    )


def sized_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size`` in words, stored once because several sums and the final pass read it."""
    return stage(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3) -> DataFrame:
    """The mix itself: the columns of ``docs``, one row for each time a document is taken.

    The one document at a source's cut is shortened to the words the budget still has (joined by one
    space, and ``n_chars`` follows); every other row is unchanged. Documents without words are not taken.
    """
    columns = docs.columns
    plan = mix(sized_documents(docs), weights, max_epochs).where("taken > 0")
    same = ["_mix_doc", "_mix_source", "_mix_n"]
    plan = plan.select(
        F.col("doc_id").alias("_mix_doc"), F.col("source").alias("_mix_source"), F.col("size").alias("_mix_n"),
        F.col("epochs").alias("_mix_epochs"), F.col("part").alias("_mix_part"),
    )
    # rows alike in all three are told apart by number; which of them gets which share does not matter
    plan = plan.withColumn("_mix_row", F.row_number().over(Window.partitionBy(*same).orderBy(F.desc("_mix_part"))))
    plan = plan.withColumnsRenamed({c: f"{c}_" for c in (*same, "_mix_row")})
    taken = docs.withColumn("_mix_doc", F.col("doc_id")).withColumn("_mix_source", F.col("source")).withColumn("_mix_n", word_count(F.col("text")))
    taken = taken.withColumn("_mix_row", F.row_number().over(Window.partitionBy(*same).orderBy("text")))
    alike = [F.equal_null(F.col(c), F.col(f"{c}_")) for c in (*same, "_mix_row")]
    taken = taken.join(plan, alike[0] & alike[1] & alike[2] & alike[3])
    whole = F.expr("if(_mix_part = _mix_n, _mix_epochs + 1, _mix_epochs)")
    copies = F.array_repeat(F.col("_mix_n"), whole.cast("int"))
    cut = F.expr("if(_mix_part > 0 and _mix_part < _mix_n, array(_mix_part), array())").cast("array<bigint>")
    taken = taken.withColumn("_mix_take", F.explode(F.concat(copies, cut)))
    head = F.array_join(F.slice(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != ""), 1, F.col("_mix_take").cast("int")), " ")
    taken = taken.withColumn("text", F.when(F.col("_mix_take") < F.col("_mix_n"), head).otherwise(F.col("text")))
    if "n_chars" in columns:
        taken = taken.withColumn("n_chars", F.when(F.col("_mix_take") < F.col("_mix_n"), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return taken.select(*columns)


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what a mix of 5, 2, 1 by source takes of it."""
    return mix(sized_documents(table(spark, sf_dir, "documents"))).select("doc_id", "size", "source_size", "target", "taken")


OP3_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size
    FROM documents
), per AS (
    SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
           CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
    FROM sized GROUP BY source
), levels AS (
    SELECT a.source, a.source_size, a.cap, a.w,
           a.cap * (SELECT sum(b.w) FROM per b WHERE b.cap * a.w > a.cap * b.w OR b.cap * a.w = a.cap * b.w)
           <= ((SELECT sum(source_size) FROM per)
               - coalesce((SELECT sum(b.cap) FROM per b WHERE b.cap * a.w < a.cap * b.w), 0)) * a.w AS is_full
    FROM per a
), targets AS (
    SELECT source, source_size,
           CASE WHEN is_full THEN cap::DOUBLE
                ELSE (((SELECT sum(source_size) FROM levels) - (SELECT coalesce(sum(cap), 0) FROM levels WHERE is_full)) * w)::DOUBLE
                     / (SELECT sum(w) FROM levels WHERE NOT is_full)::DOUBLE END AS target
    FROM levels
), running AS (
    SELECT s.doc_id, s.size, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS budget,
           coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY md5(s.doc_id::VARCHAR), s.doc_id, s.size
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size = 0 THEN 0
             ELSE (budget // source_size) * size + greatest(0, least(size, budget % source_size - ahead)) END)::BIGINT AS taken
FROM running
"""
