"""E3 and its by-year twin: macro-genre shares as pivot tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.functions.decades import decade_open
from trendloom.functions.genres import (
    GENRE_RULES_BATCH,
    GENRE_RULES_DASHBOARD,
    macro_genre,
    rule_labels,
)
from trendloom.functions.numeric import strict_int, to_nullable_int
from trendloom.operators.aggregates import count_by
from trendloom.operators.columns import require_columns
from trendloom.operators.pivots import pivot_table
from trendloom.operators.windows import share_within


def with_macro_genre(df: DataFrame, rules=GENRE_RULES_BATCH, col: str = "genre",
                     out: str = "macro_genre") -> DataFrame:
    is_text = isinstance(df.schema[col].dataType, T.StringType)
    return df.withColumn(out, macro_genre(F.col(col), rules, is_text))


def labelled(enriched: DataFrame, rules=GENRE_RULES_BATCH, strict: bool = True) -> DataFrame:
    """X11 + X6 + X7/X8: integer year, open decade label and macro genre."""
    require_columns(enriched, ["genre", "year"])
    year = strict_int("year", "year") if strict else to_nullable_int("year", enriched.schema["year"].dataType)
    df = enriched.withColumn("year", year)
    df = df.withColumn("generation", decade_open(F.col("year")))
    return with_macro_genre(df, rules)


def genre_counts(enriched: DataFrame, by: str = "generation", rules=GENRE_RULES_BATCH,
                 strict: bool = True) -> DataFrame:
    """A3/A4: tracks per (label, macro genre)."""
    return count_by(labelled(enriched, rules, strict), [by, "macro_genre"])


def genre_shares(enriched: DataFrame, by: str = "generation", rules=GENRE_RULES_BATCH,
                 strict: bool = True) -> DataFrame:
    """W1 + W2: count, label total and percentage per (label, macro genre)."""
    return share_within(genre_counts(enriched, by, rules, strict), [by])


def genre_share_by_generation(enriched: DataFrame, rules=GENRE_RULES_BATCH,
                              strict: bool = True) -> DataFrame:
    """A6 + O4: generation x macro-genre percentage table (missing -> 0)."""
    shares = genre_shares(enriched, "generation", rules, strict)
    return pivot_table(shares, "generation", "macro_genre", "pct",
                       categories=rule_labels(rules), fill=0.0).orderBy("generation")


def genre_share_by_year(enriched: DataFrame, rules=GENRE_RULES_DASHBOARD,
                        strict: bool = True) -> DataFrame:
    """A4 + A7 + P14: year x macro-genre percentage table, year as text label."""
    shares = genre_shares(enriched, "year", rules, strict)
    table = pivot_table(shares, "year", "macro_genre", "pct",
                        categories=rule_labels(rules), fill=0.0)
    return table.orderBy("year").withColumn("year", F.col("year").cast("string"))


def run_genre_share(spark, layout, decimals: int = 2) -> str:
    """E3 end to end: enriched CSV -> percentage table CSV with fixed decimals (K3)."""
    from trendloom.sources.readers import load_enriched
    from trendloom.sources.writers import write_csv_decimals

    table = genre_share_by_generation(load_enriched(spark, layout))
    return write_csv_decimals(table, layout.genre_share, decimals, single_file=True)
