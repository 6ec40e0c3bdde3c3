"""Window-style operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def share_within(counts: DataFrame, partition: list[str], count_col: str = "count",
                 total_col: str = "total", pct_col: str = "pct") -> DataFrame:
    """W1 + W2: partition total on every row and the percentage share.

    Runs on already-aggregated counts (one row per group x category), so the
    window's partitions are small whatever the input size.
    """
    w = Window.partitionBy(*partition)
    return (counts
            .withColumn(total_col, F.sum(count_col).over(w))
            .withColumn(pct_col, F.col(count_col) / F.col(total_col) * F.lit(100)))


def top_n_per_group(df: DataFrame, group: list[str], order_col: str, n: int = 10,
                    tie_break: list[str] | None = None) -> DataFrame:
    """The n largest rows of ``order_col`` per group.

    ``row_number() <= n`` plans as WindowGroupLimit, applied once before the
    shuffle (per task) and once after, so each group ships at most
    n rows per map task however many rows it holds.
    """
    order = [F.col(order_col).desc_nulls_last()] + [F.col(c).asc() for c in (tie_break or [])]
    w = Window.partitionBy(*group).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") <= n)
              .drop("_rn"))
