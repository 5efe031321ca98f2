"""Hashes, dates and amounts. Parsing never throws under ANSI mode: bad input becomes NULL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline.functions.text import as_column

# Fixed value: separator between the hashed fields of a record.
HASH_SEPARATOR = "||"


def record_hash(columns: Iterable[str]) -> Column:
    """SHA-256 over the named columns as text, NULL hashed as the empty string."""
    fields = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *fields), 256)


def safe_date(value: Column | str) -> Column:
    return F.try_to_date(as_column(value).cast("string"), "yyyy-MM-dd")


def currency(value: Column | str) -> Column:
    """Amount as a double with two places, NULL when it does not parse."""
    return F.round(as_column(value).try_cast("double"), 2)


def money(value: Column | str) -> Column:
    """Exact amount: sums do not depend on the order in which partitions are added up."""
    return as_column(value).try_cast("decimal(18,2)")


def outstanding(amount: Column | str, paid: Column | str) -> Column:
    return F.round(as_column(amount) - as_column(paid), 2)


def weighted_score_sql(parts: Iterable[tuple[str, float]], renormalize: bool = True) -> str:
    """Weighted mean of part scores, given as SQL, to four places.

    With ``renormalize`` a NULL part takes no share of the weight, so a record is judged on the
    evidence that exists (0 when there is none); without it the plain weighted sum is returned.
    """
    parts = list(parts)
    total = " + ".join(f"coalesce({score} * {share}D, 0.0D)" for score, share in parts)
    if not renormalize:
        return f"round({total}, 4)"
    weight = " + ".join(f"CASE WHEN {score} IS NULL THEN 0.0D ELSE {share}D END" for score, share in parts)
    return f"CASE WHEN {weight} > 0 THEN round(({total}) / ({weight}), 4) ELSE 0.0D END"


def weighted_score(parts: Iterable[tuple[str, float]], renormalize: bool = True) -> Column:
    """The same over column names."""
    return F.expr(weighted_score_sql(parts, renormalize))
