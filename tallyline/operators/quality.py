"""Checks that count or return the rows breaking a rule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions import is_blank, outstanding
from tallyline.operators.skew import skew_join


def required_field_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: per column the number of NULL or blank values (0 on empty input)."""
    return df.agg(*[F.count_if(is_blank(c)).alias(c) for c in columns])


def completeness(df: DataFrame, columns: Sequence[str], minimum: float = 0.98) -> DataFrame:
    """Per column the share of filled values and whether it reaches ``minimum``; one pass."""
    shares = [F.avg(F.when(is_blank(c), 0.0).otherwise(1.0)).alias(c) for c in columns]
    long = ", ".join(f"'{c}', `{c}`" for c in columns)
    return (
        df.agg(*shares)
        .selectExpr(f"stack({len(columns)}, {long}) AS (column_name, completeness)")
        .withColumn("passed", F.coalesce(F.col("completeness") >= minimum, F.lit(True)))
    )


def orphans(child: DataFrame, parent: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Child rows without a parent. A NULL key has no parent and is an orphan."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return skew_join(child, parent.select(*keys).distinct(), keys, "left_anti").select(*child.columns)


def referential_integrity_orphans(child: DataFrame, parent: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """One row with the number of orphans. Rows are counted per key first, so no key is large in the join."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    counted = child.groupBy(*keys).agg(F.count("*").alias("_n"))
    lost = counted.join(parent.select(*keys).distinct(), keys, "left_anti")
    return lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_count"))


def missing_value(df: DataFrame, column: str) -> DataFrame:
    return df.where(is_blank(column))


def study_protocol_required(df: DataFrame) -> DataFrame:
    return missing_value(df, "protocol_no_std")


def sponsor_external_id_required(df: DataFrame) -> DataFrame:
    return missing_value(df, "sponsor_external_id_std")


def amount_below(df: DataFrame, amount: str, paid: str) -> DataFrame:
    return df.where(F.col(amount) < F.col(paid))


def invoice_amount_gte_paid(df: DataFrame) -> DataFrame:
    return amount_below(df, "invoice_amount_std", "paid_amount_std")


def outstanding_matches_formula(df: DataFrame) -> DataFrame:
    return df.where(outstanding("invoice_amount_std", "paid_amount_std") != F.col("outstanding_amount_std"))


def contract_value_positive(df: DataFrame) -> DataFrame:
    return df.where(F.col("contract_value_std") <= 0)


def rule_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows breaking each rule, one pass for all rules: (rule, violations)."""
    counts = df.agg(*[F.count_if(broken).alias(code) for code, broken in rules.items()])
    long = ", ".join(f"'{code}', `{code}`" for code in rules)
    return counts.selectExpr(f"stack({len(rules)}, {long}) AS (rule, violations)")
