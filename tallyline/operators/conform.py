"""Standardize, key, deduplicate, validate and split records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions import (
    business_key,
    currency,
    join_reasons,
    normalize_text,
    normalize_token,
    safe_date,
)
from tallyline.operators.dedupe import deduplicate_by_key

FORMS = {"text": normalize_text, "token": normalize_token, "date": safe_date, "currency": currency}


@dataclass(frozen=True)
class ConformSpec:
    """How one entity is conformed.

    ``standard`` maps a new column to (form, raw column); ``key`` lists (form, raw column) parts of
    the business key; ``rules`` maps a reason code to the SQL condition that breaks the record,
    written over raw and standardized columns.
    """

    standard: Mapping[str, tuple[str, str]]
    key: Sequence[tuple[str, str]]
    rules: Mapping[str, str] = field(default_factory=dict)


def restricted(spec: ConformSpec, raw: Sequence[str]) -> ConformSpec:
    """The same key and rules for tables that hold only these raw columns, which the key and rules have to do with."""
    return replace(spec, standard={name: (form, column) for name, (form, column) in spec.standard.items() if column in raw})


def standardize(df: DataFrame, mapping: Mapping[str, tuple[str, str]], null_as_blank: bool = False) -> DataFrame:
    """Add standardized columns beside the raw ones, all in one projection."""
    columns = {}
    for name, (form, raw) in mapping.items():
        if form in ("text", "token"):
            columns[name] = FORMS[form](raw, null_as_blank=null_as_blank)
        else:
            columns[name] = FORMS[form](raw)
    return df.withColumns(columns)


def normalize_join_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Token form of several columns in place; NULL stays NULL."""
    return df.withColumns({c: normalize_token(c) for c in columns})


def conform(df: DataFrame, spec: ConformSpec) -> DataFrame:
    """One row per business key with its standardized columns and ``invalid_reason``.

    The newest row of a key wins before it is judged, so a newest row that breaks a rule hides an
    older valid one. Rows whose key parts are all blank have nothing in common: they skip the
    deduplication and the shuffle, and each is judged by itself. Only the key is computed ahead of
    the shuffle; the other columns and the rules are evaluated on the surviving rows.
    """
    parts = [FORMS[form](raw) for form, raw in spec.key]
    keyed = df.withColumn("business_key", business_key(*parts))
    keyless = F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts]) == ""
    newest = deduplicate_by_key(keyed.where(~keyless), "business_key").unionByName(keyed.where(keyless))
    return standardize(newest, spec.standard).withColumn("invalid_reason", join_reasons({code: F.expr(rule) for code, rule in spec.rules.items()}))


def split(conformed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected). To write both use ``write_conformed``, which reads the input once."""
    return conformed.where(F.col("invalid_reason") == ""), conformed.where(F.col("invalid_reason") != "")


def blank(column: str) -> str:
    """Rule: the column is NULL, empty or all spaces."""
    return f"coalesce(trim({column}), '') = ''"
