"""Macro-genre classification from free-text genre labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendloom.functions.text import contains_any

# The two rule lists of the reference, in evaluation order
# (first matching rule wins; unmatched or non-text genres are "Other").
GENRE_RULES_BATCH = [
    ("Pop", ["pop"]),
    ("Rock", ["rock"]),
    ("Rap", ["hip hop", "rap", "trap"]),
    ("Funk", ["funk"]),
    ("Electronic", ["electro", "house", "techno", "edm", "dance"]),
]
GENRE_RULES_DASHBOARD = [
    ("Pop", ["pop"]),
    ("Latin", ["latin", "latino", "reggaeton", "salsa", "bachata"]),
    ("Boy Band", ["boy band", "boyband", "k-pop", "kpop"]),
    ("Rap", ["hip hop", "rap", "trap"]),
    ("Rock", ["rock"]),
    ("Electronic", ["electro", "house", "techno", "edm", "dance"]),
    ("Funk", ["funk"]),
]
OTHER = "Other"


def rule_labels(rules: list[tuple[str, list[str]]]) -> list[str]:
    """Every label a rule list can produce, sorted (pivot column order)."""
    return sorted({label for label, _ in rules} | {OTHER})


def macro_genre(c: Column | str, rules: list[tuple[str, list[str]]] = GENRE_RULES_BATCH,
                is_text: bool = True) -> Column:
    """Ordered CASE over lower-cased substring rules."""
    if not is_text:
        return F.lit(OTHER)
    c = F.col(c) if isinstance(c, str) else c
    expr = None
    for label, needles in rules:
        cond = contains_any(c, needles)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(OTHER)) if expr is not None else F.lit(OTHER)


def macro_genre_batch(c: Column | str, is_text: bool = True) -> Column:
    return macro_genre(c, GENRE_RULES_BATCH, is_text)


def macro_genre_dashboard(c: Column | str, is_text: bool = True) -> Column:
    return macro_genre(c, GENRE_RULES_DASHBOARD, is_text)
