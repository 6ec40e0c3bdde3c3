"""Pure Column expressions (no UDFs): every function stays inside codegen."""

from trendloom.functions.decades import (
    decade_clamped,
    decade_open,
    decade_sort_key,
    year_from_text,
)
from trendloom.functions.genres import (
    GENRE_RULES_BATCH,
    GENRE_RULES_DASHBOARD,
    macro_genre,
    macro_genre_batch,
    macro_genre_dashboard,
    rule_labels,
)
from trendloom.functions.numeric import (
    digits_only,
    strict_int,
    to_double,
    to_int64,
    to_nullable_int,
)
from trendloom.functions.text import (
    blank_default,
    contains_any,
    first_artist,
    normalize_text,
    split_fields,
    strip_whitespace,
)

__all__ = [
    "GENRE_RULES_BATCH", "GENRE_RULES_DASHBOARD", "blank_default", "contains_any",
    "decade_clamped", "decade_open", "decade_sort_key", "digits_only", "first_artist",
    "macro_genre", "macro_genre_batch", "macro_genre_dashboard", "normalize_text",
    "rule_labels", "split_fields", "strict_int", "strip_whitespace", "to_double",
    "to_int64", "to_nullable_int", "year_from_text",
]
