"""Column expressions shared by the operators."""

from catalograph.functions.expressions import (
    MISSING_TOKENS,
    finite,
    has_all_keys,
    is_blank,
    missing_to_null,
    revenue,
    round_to,
    table_name_of,
    thousands,
)

__all__ = [
    "MISSING_TOKENS",
    "finite",
    "has_all_keys",
    "is_blank",
    "missing_to_null",
    "revenue",
    "round_to",
    "table_name_of",
    "thousands",
]
