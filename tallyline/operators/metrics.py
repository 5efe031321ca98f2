"""Reconciliation metrics in long form: (metric_group, metric_name, metric_value).

Every metric is an aggregation that stays in the plan, so a report made of many metrics is one
query and nothing is collected to the driver in between.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.changes import CHANGE_TYPES, INSERT, NO_CHANGE, UPDATE
from tallyline.operators.skew import skew_join

METRIC_COLUMNS = ("metric_group", "metric_name", "metric_value")


def metric_rows(one_row: DataFrame, metrics: Mapping[str, Column], group: str) -> DataFrame:
    """A one-row aggregate as one row per metric."""
    entries = [F.struct(F.lit(n).alias("metric_name"), v.cast("double").alias("metric_value")) for n, v in metrics.items()]
    return one_row.select(F.explode(F.array(*entries)).alias("_m")).select(F.lit(group).alias("metric_group"), "_m.*")


def _total(column: str | Column) -> Column:
    """Exact sum: doubles with two places add up differently in every order, decimals do not."""
    value = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.sum(value.try_cast("decimal(18,2)")), F.lit(0))


def _two_sided(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row from two one-row aggregates: partial results are united and added up."""
    return source.withColumn("side", F.lit("s")).unionByName(target.withColumn("side", F.lit("t")))


def _compare(source: DataFrame, target: DataFrame, names: tuple[str, str, str], group: str) -> DataFrame:
    both = _two_sided(source, target).agg(
        F.max(F.when(F.col("side") == "s", F.col("v"))).alias("s"),
        F.max(F.when(F.col("side") == "t", F.col("v"))).alias("t"),
    )
    s, t = F.col("s"), F.col("t")
    return metric_rows(both, dict(zip(names, (s, t, t - s))), group)


def source_vs_target_record_count(source: DataFrame, target: DataFrame, group: str) -> DataFrame:
    names = ("source_record_count", "target_record_count", "record_count_delta")
    count = F.count("*").alias("v")
    return _compare(source.agg(count), target.agg(count), names, group)


def source_vs_target_total(
    source: DataFrame, source_col: str, target: DataFrame, target_col: str, group: str
) -> DataFrame:
    """Totals and target minus source. Text amounts are parsed; what does not parse adds nothing."""
    names = ("source_total", "target_total", "total_delta")
    return _compare(
        source.agg(_total(source_col).alias("v")), target.agg(_total(target_col).alias("v")), names, group
    )


def unparsed_count(df: DataFrame, column: str, group: str) -> DataFrame:
    """Amounts that are there but add nothing to a total: they do not parse or do not fit."""
    value = F.col(column)
    lost = value.isNotNull() & (F.trim(value.cast("string")) != "") & value.try_cast("decimal(18,2)").isNull()
    return metric_rows(df.agg(F.count_if(lost).alias("n")), {"unparsed_count": F.col("n")}, group)


def rejected_record_count(rejected: DataFrame, group: str = "quality") -> DataFrame:
    return metric_rows(rejected.agg(F.count("*").alias("n")), {"rejected_record_count": F.col("n")}, group)


def malformed_line_count(broken: Sequence[DataFrame], group: str = "quality") -> DataFrame:
    """Lines of all feeds that could not be parsed."""
    lines = None
    for df in broken:
        one = df.select(F.lit(1).alias("line"))
        lines = one if lines is None else lines.unionByName(one)
    return metric_rows(lines.agg(F.count("*").alias("n")), {"malformed_line_count": F.col("n")}, group)


def duplicate_count(df: DataFrame, keys: Sequence[str], group: str = "quality") -> DataFrame:
    """Rows beyond the first of their key; NULL keys count as one key."""
    surplus = df.groupBy(*keys).agg((F.count("*") - 1).alias("extra")).agg(F.sum("extra").alias("n"))
    return metric_rows(surplus, {"duplicate_count": F.coalesce("n", F.lit(0))}, group)


def match_accuracy(
    crosswalk: DataFrame,
    confidence: str = "overall_match_confidence",
    threshold: float = 0.97,
    group: str = "entity_resolution",
) -> DataFrame:
    """Matches at or above the threshold, all matches, and their ratio (0 on empty input)."""
    counts = crosswalk.agg(F.count_if(F.col(confidence) >= threshold).alias("high"), F.count("*").alias("n"))
    high, n = F.col("high"), F.col("n")
    return metric_rows(
        counts,
        {
            "high_confidence_match_count": high,
            "total_match_count": n,
            "match_accuracy": F.when(n > 0, high / n).otherwise(F.lit(0.0)),
        },
        group,
    )


def labelled_accuracy(
    scored: DataFrame,
    expected: str = "expected_match",
    confidence: str = "overall_match_confidence",
    threshold: float = 0.97,
) -> DataFrame:
    """One row: accuracy, precision, recall and F1 of ``confidence >= threshold`` against the labels."""
    predicted = F.coalesce(F.col(confidence), F.lit(0.0)) >= threshold
    truth = F.col(expected)
    counts = scored.agg(
        F.avg(F.when(predicted == truth, 1.0).otherwise(0.0)).alias("right"),
        F.count_if(predicted & truth).alias("tp"),
        F.count_if(predicted).alias("positive"),
        F.count_if(truth).alias("labelled"),
    )
    precision = F.coalesce(F.try_divide("tp", "positive"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("tp", "labelled"), F.lit(0.0))
    return counts.select(
        F.coalesce("right", F.lit(0.0)).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        F.coalesce(F.try_divide(F.col("tp") * 2.0, F.col("positive") + F.col("labelled")), F.lit(0.0)).alias("f1"),
    )


def score_labels(labels: DataFrame, crosswalk: DataFrame, keys: Sequence[str], confidence: str = "overall_match_confidence") -> DataFrame:
    """Labelled pairs with the confidence of the crosswalk, 0 where it has no such pair.

    A crosswalk may list a pair once per invoice; it is cut to distinct pairs so labels do not multiply.
    """
    pairs = crosswalk.groupBy(*keys).agg(F.max(confidence).alias(confidence))
    return skew_join(labels, pairs, list(keys), "left").fillna({confidence: 0.0})


def runtime_metric(spark: SparkSession, started: datetime, ended: datetime, group: str = "runtime") -> DataFrame:
    seconds = (ended - started).total_seconds()
    return metric_rows(spark.range(1), {"load_runtime_seconds": F.lit(float(seconds))}, group)


def change_type_counts(changes: DataFrame, group: str = "delta_load") -> DataFrame:
    """Rows per change type, 0 for types that do not occur."""
    counts = changes.agg(*[F.count_if(F.col("change_type") == kind).alias(kind) for kind in CHANGE_TYPES])
    return metric_rows(counts, {f"{kind}_count": F.col(kind) for kind in CHANGE_TYPES}, group)


def change_counts_of_versions(changes: DataFrame, records: DataFrame, group: str = "delta_load") -> DataFrame:
    """The same where only changing rows are stored: ``records`` holds the rows after the changes, and
    those neither inserted nor updated have not changed."""
    kinds = [k for k in CHANGE_TYPES if k != NO_CHANGE]
    counted = changes.agg(*[F.count_if(F.col("change_type") == k).alias(k) for k in kinds], F.lit(0).cast("long").alias("n"))
    whole = records.agg(*[F.lit(0).cast("long").alias(k) for k in kinds], F.count("*").alias("n"))
    both = counted.unionByName(whole).agg(*[F.sum(c).alias(c) for c in (*kinds, "n")])
    same = F.col("n") - F.col(INSERT) - F.col(UPDATE)
    return metric_rows(both, {f"{k}_count": same if k == NO_CHANGE else F.col(k) for k in CHANGE_TYPES}, group)


def assemble_report(*metrics: DataFrame, generated_at: datetime | None = None) -> DataFrame:
    """All metric rows with one report timestamp."""
    report = metrics[0]
    for more in metrics[1:]:
        report = report.unionByName(more)
    stamp = F.current_timestamp() if generated_at is None else F.lit(generated_at)
    return report.withColumn("report_generated_ts", stamp)


def threshold_alerts(report: DataFrame, limits: DataFrame) -> DataFrame:
    """Metrics outside their limits. ``limits``: metric_group, metric_name, lowest, highest (NULL: none)."""
    found = report.join(limits, ["metric_group", "metric_name"])
    return found.where((F.col("metric_value") < F.col("lowest")) | (F.col("metric_value") > F.col("highest")))


def audit_summary(tables: Mapping[str, tuple[DataFrame, str | None]], audited_at: datetime | None = None) -> DataFrame:
    """Per table its row count and, where an amount column is named, the total. One query for all."""
    rows = None
    for name, (df, amount) in tables.items():
        total = F.lit(None).cast("double") if amount is None else _total(amount).cast("double")
        row = df.agg(F.count("*").alias("record_count"), total.alias("amount_total")).select(
            F.lit(name).alias("table_name"), "record_count", "amount_total"
        )
        rows = row if rows is None else rows.unionByName(row)
    stamp = F.current_timestamp() if audited_at is None else F.lit(audited_at)
    return rows.withColumn("audit_timestamp", stamp)


def ar_reconciliation(
    invoices: DataFrame,
    payments: DataFrame,
    keys: Sequence[str] = ("sponsor_name", "study_name"),
    billed: str = "invoice_amount",
    paid: str = "payment_amount",
    how: str = "left",
) -> DataFrame:
    """Billed, paid and outstanding per key.

    Both sides are added up in each task before the shuffle, and the join reuses the partitioning
    of the two aggregations. ``how="full"`` also lists payments without an invoice.
    """
    keys = list(keys)
    inv = invoices.groupBy(*keys).agg(F.sum(F.col(billed).try_cast("decimal(18,2)")).alias("billed_amount"))
    pay = payments.groupBy(*keys).agg(F.sum(F.col(paid).try_cast("decimal(18,2)")).alias("paid_amount"))
    joined = inv.join(pay, keys, how)
    zero = F.lit(0).cast("decimal(28,2)")
    bill = F.coalesce("billed_amount", zero) if how == "full" else F.col("billed_amount")
    settled = F.coalesce("paid_amount", zero)
    return joined.select(
        *keys,
        bill.cast("double").alias("billed_amount"),
        settled.cast("double").alias("paid_amount"),
        (bill - settled).cast("double").alias("outstanding_amount"),
    )
