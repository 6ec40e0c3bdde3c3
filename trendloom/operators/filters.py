"""Row filters and predicates.

Data-dependent choices (the year fallback, default range bounds) are scalar
subqueries: they stay inside one lazy plan, run as a one-row aggregate with
map-side partial aggregation, and never pull rows to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.functions.decades import YEAR_MAX, YEAR_MIN
from trendloom.functions.text import split_fields

ALL = "(Todos)"  # fixed value: the "no filter" choice of the drill-down


def year_in_range(c: Column | str = "year", lo: int = YEAR_MIN, hi: int = YEAR_MAX) -> Column:
    """inclusive range; null is not in range."""
    c = F.col(c) if isinstance(c, str) else c
    return c.between(lo, hi)


def any_in_range_agg(year_col: str = "year", lo: int = YEAR_MIN, hi: int = YEAR_MAX) -> Column:
    """A13-style aggregate for F2: 1 when some year is in range, else 0."""
    return F.coalesce(F.max(year_in_range(year_col, lo, hi).cast("int")), F.lit(0))


def filter_years_with_fallback(df: DataFrame, year_col: str = "year",
                               lo: int = YEAR_MIN, hi: int = YEAR_MAX,
                               any_in_range: Column | None = None) -> DataFrame:
    """F1 + F2: keep in-range years; if none is in range but some year is
    non-null, keep every non-null year instead.

    ``any_in_range`` may be passed in when the caller already computes it in
    a shared scalar subquery (one pass for several guards).
    """
    y = F.col(year_col)
    if any_in_range is None:
        any_in_range = df.agg(any_in_range_agg(year_col, lo, hi).alias("any_in_range")).scalar()
    return df.filter(year_in_range(y, lo, hi) | ((any_in_range == 0) & y.isNotNull()))


def equals_filter(df: DataFrame, col: str, value) -> DataFrame:
    """equality; None or '(Todos)' means no filter."""
    if value is None or value == ALL:
        return df
    return df.filter(F.col(col) == F.lit(value))


def range_filter(df: DataFrame, col: str, lo=None, hi=None,
                 truncate_bounds: bool = False) -> DataFrame:
    """inclusive range; a null or NaN is in no range.

    A missing bound holds every value, as floor(min) or ceil(max) would (D7),
    and needs no pass over the data. ``truncate_bounds=True`` takes int() of
    the data's own min and max, like the reference slider (NaN left out).
    """
    c = F.col(col)
    real = isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType))
    value = F.nanvl(c, F.lit(None).cast("double")) if real else c
    if truncate_bounds and (lo is None or hi is None):
        ends = [f(value).cast("double").try_cast("bigint") for f in (F.min, F.max)]
        bounds = df.agg(F.struct(ends[0].alias("lo"), ends[1].alias("hi")).alias("b")).scalar()
        lo = bounds.getField("lo") if lo is None else lo
        hi = bounds.getField("hi") if hi is None else hi
    held = value.isNotNull()
    if lo is not None:
        held &= c >= lo
    if hi is not None:
        held &= c <= hi
    return df.filter(held)


def isin_filter(df: DataFrame, col: str, values: list) -> DataFrame:
    """membership in a caller-given list."""
    return df.filter(F.col(col).isin(list(values)))


def is_empty(df: DataFrame) -> bool:
    """empty-result test (a LIMIT 1 job, never a full count)."""
    return df.isEmpty()


# A Python int() literal: optional sign, digits with single underscores, outer whitespace.
INT_TEXT = r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"


def accepted_line(line: Column, header_prefix: str = "generation,") -> Column:
    """whether a line is no header, has three fields or more and an integer in the third."""
    parts = split_fields(line)
    return F.coalesce(~line.startswith(header_prefix) & (F.size(parts) >= 3) & F.get(parts, 2).rlike(INT_TEXT), F.lit(False))


def key_value_fields(lines: DataFrame, key_names: tuple[str, str],
                     defaults: tuple[str, str], value_name: str = "streams",
                     header_prefix: str = "generation,") -> DataFrame:
    """S6 + F7 + X12 as one projection: the line mapper of the reference's
    MapReduce jobs, with a null value for every line it would drop.

    Input is a DataFrame with a ``value`` text column (``spark.read.text``).
    Each line is split on every comma without quoting; header lines, lines
    with fewer than three fields and lines whose third field is not an
    integer are rejected; blank keys take their defaults.
    """
    v = F.col("value")
    parts = split_fields(v)
    third = F.get(parts, 2)
    ok = accepted_line(v, header_prefix)
    k1, k2 = key_names
    d1, d2 = defaults
    return lines.select(
        F.coalesce(F.nullif(F.get(parts, 0), F.lit("")), F.lit(d1)).alias(k1),
        F.coalesce(F.nullif(F.get(parts, 1), F.lit("")), F.lit(d2)).alias(k2),
        F.when(ok, F.regexp_replace(third, r"[\s_]", "").try_cast("bigint")).alias(value_name),
    )


def parse_key_value_lines(lines: DataFrame, key_names: tuple[str, str],
                          defaults: tuple[str, str], value_name: str = "streams",
                          header_prefix: str = "generation,") -> DataFrame:
    """Row-level mapper output: only the accepted lines."""
    fields = key_value_fields(lines, key_names, defaults, value_name, header_prefix)
    return fields.filter(F.col(value_name).isNotNull())


def sum_key_value_lines(lines: DataFrame, key_names: tuple[str, str],
                        defaults: tuple[str, str], total_name: str = "total_streams",
                        header_prefix: str = "generation,") -> DataFrame:
    """Mapper + reducer: totals per key pair over the accepted lines.

    Rejected lines only carry a null value, and a key pair is kept when at
    least one accepted line feeds it. The check sits above the aggregate, so
    Catalyst cannot push it down and re-evaluate the line expression per row.
    """
    fields = key_value_fields(lines, key_names, defaults, "_v", header_prefix)
    k1, k2 = key_names
    agg = fields.groupBy(k1, k2).agg(F.sum("_v").alias(total_name), F.count("_v").alias("_accepted"))
    return agg.filter(F.col("_accepted") > 0).drop("_accepted")
