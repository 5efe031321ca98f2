"""Text forms used as match and business keys. All are built-in expressions, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how a batch date is spelled in a landing path.
BATCH_DATE_PATTERN = r"batch_date=(\d{4}-\d{2}-\d{2})"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _as_string(value: Column | str, null_as_blank: bool) -> Column:
    text = as_column(value).cast("string")
    return F.coalesce(text, F.lit("")) if null_as_blank else text


def normalize_text(value: Column | str, null_as_blank: bool = False) -> Column:
    """Upper case, runs of white space folded to one space, ends trimmed."""
    folded = F.regexp_replace(_as_string(value, null_as_blank), r"\s+", " ")
    return F.upper(F.trim(folded))


def normalize_token(value: Column | str, null_as_blank: bool = False) -> Column:
    """Upper case with everything but A-Z and 0-9 removed."""
    return F.regexp_replace(F.upper(_as_string(value, null_as_blank)), r"[^A-Z0-9]", "")


def is_blank(value: Column | str) -> Column:
    """NULL, empty and all-space count alike; CSV reads empty fields as NULL."""
    column = as_column(value)
    return column.isNull() | (F.trim(column.cast("string")) == "")


def business_key(*parts: Column | str) -> Column:
    """Parts joined with ``|``. A missing part keeps its place, so keys of different shape cannot collide."""
    return F.concat_ws("|", *[F.coalesce(as_column(p).cast("string"), F.lit("")) for p in parts])


def join_reasons(rules: Mapping[str, Column]) -> Column:
    """Codes of the rules that hold, joined with ``|``; empty when none does."""
    return F.concat_ws("|", *[F.when(broken, F.lit(code)) for code, broken in rules.items()])


def batch_date_from_path(path: Column | str) -> Column:
    """``yyyy-MM-dd`` found after ``batch_date=``, or the empty string."""
    return F.regexp_extract(as_column(path), BATCH_DATE_PATTERN, 1)


def similarity_sql(left: str, right: str) -> str:
    """``1 - edit distance / longer length`` to four places; two empty strings are equal."""
    longer = f"greatest(length({left}), length({right}))"
    return f"CASE WHEN {longer} = 0 THEN 1.0D ELSE round(1 - levenshtein({left}, {right}) / {longer}, 4) END"


def similarity(left: Column | str, right: Column | str) -> Column:
    """The same for columns."""
    a, b = as_column(left), as_column(right)
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, F.lit(1.0)).otherwise(F.round(1 - F.levenshtein(a, b) / longer, 4))
