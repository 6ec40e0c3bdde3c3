"""Sorts, limits and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendloom.functions.decades import decade_sort_key


def total_order(tie_break: list[str] | None = None, col: str = "total_streams") -> list[Column]:
    """O1's keys: descending totals, then ``tie_break``."""
    return [F.col(col).desc_nulls_last(), *[F.col(c).asc() for c in (tie_break or [])]]


def sort_by_total_desc(df: DataFrame, tie_break: list[str] | None = None,
                       col: str = "total_streams") -> DataFrame:
    """O1: descending totals (only when the column exists); deterministic ties."""
    if col not in df.columns:
        return df
    return df.orderBy(*total_order(tie_break, col))


def order_decades(df: DataFrame, col: str = "generation", *then) -> DataFrame:
    """O2 + O3: decades in numeric order, unparsable labels last."""
    return df.orderBy(*decade_order(col), *then)


def top_rows(df: DataFrame, order_col: str, n: int, tie_break: list[str] | None = None) -> DataFrame:
    """The n rows with the largest ``order_col`` (nulls last).

    Plans as TakeOrderedAndProject: a per-task top-n, then one merge of
    n rows per task.
    """
    tie_break = tie_break if tie_break is not None else [c for c in df.columns if c != order_col]
    return df.orderBy(F.col(order_col).desc_nulls_last(),
                      *[F.col(f"`{c}`").asc_nulls_last() for c in tie_break]).limit(n)


def global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """O1-O4, O8 as a column: 1 for the first row of the whole order, 2 for the next, ...

    Rows are dealt by ranges of the order and sorted in their partitions, then
    written with partition and place; a rank is the place plus the sizes of the
    partitions before (one row each), so no task sees all rows. The order should
    be total: equal rows may come in any order. The written table stands in the
    session's scratch folder.
    """
    from trendloom.session import scratch_path

    spark, place = df.sparkSession, F.monotonically_increasing_id()
    path = scratch_path(spark, "ranked")
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_rows.select("*", F.shiftright(place, 33).alias("_part"), place.bitwiseAND((1 << 33) - 1).alias("_place")).write.parquet(path)
    placed = spark.read.parquet(path)
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rank = (F.col("_place") + F.col("_before") + 1).cast("long").alias(name)
    return placed.join(parts, "_part").select(*[F.col(f"`{c}`") for c in df.columns], rank)


def decade_order(col: str = "generation") -> list[Column]:
    """O2 + O3: the keys of decades in numeric order, unparsable labels last."""
    return [decade_sort_key(F.col(col)).asc_nulls_last(), F.col(col).asc_nulls_last()]


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first n rows (no order promised)."""
    return df.limit(n)
