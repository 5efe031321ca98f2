"""Column expressions: text forms, hashes, safe parsing, similarity."""

from tallyline.functions.text import (
    batch_date_from_path,
    business_key,
    is_blank,
    join_reasons,
    normalize_text,
    normalize_token,
    similarity,
    similarity_sql,
)
from tallyline.functions.values import (
    currency,
    money,
    outstanding,
    record_hash,
    safe_date,
    weighted_score,
    weighted_score_sql,
)

__all__ = [
    "batch_date_from_path",
    "business_key",
    "currency",
    "is_blank",
    "join_reasons",
    "money",
    "normalize_text",
    "normalize_token",
    "outstanding",
    "record_hash",
    "safe_date",
    "similarity",
    "similarity_sql",
    "weighted_score",
    "weighted_score_sql",
]
