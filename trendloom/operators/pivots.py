"""Pivots (A6-A8): rows per label, one column per category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.session import scratch_path

#: Columns that a pivot over values found in the data may have.
MAX_CATEGORIES = 1000


def categories_of(df: DataFrame, column: str, limit: int = MAX_CATEGORIES) -> list:
    """The distinct non-null values of a column, in order; an error names the limit if there are more."""
    found = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column).limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{column!r} has more than {limit} values to make columns of; name the ones to keep")
    return found


def pivot_table(df: DataFrame, index: str, columns: str, values: str,
                categories: list | None = None, aggfunc: str = "sum",
                fill=0) -> DataFrame:
    """Pivot ``values`` by ``columns`` per ``index``; empty cells take ``fill``.

    Pass ``categories`` whenever they are known. Else ``df`` is written to the
    scratch folder first (it holds aggregates), so that finding the values and
    pivoting them both read that table and the plan above it runs once.
    For one-value-per-cell pivots (A6/A7) ``sum`` returns that value exactly.
    """
    agg = {"sum": F.sum, "first": F.first, "max": F.max, "min": F.min}[aggfunc]
    if categories is None:
        path = scratch_path(df.sparkSession, "pivot")
        df.select(index, columns, values).write.parquet(path)
        df = df.sparkSession.read.parquet(path)
        categories = categories_of(df, columns)
    out = df.groupBy(index).pivot(columns, categories).agg(agg(values))
    if fill is not None:
        out = out.na.fill(fill, subset=[c for c in out.columns if c != index])
    return out
