"""Aggregations (A1-A5, A10-A13). All are hash aggregates with a map-side
partial step, so a hot key (one decade holding a third of the rows) is
combined inside each task before the shuffle."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.functions.numeric import to_int64
from trendloom.functions.text import blank_default
from trendloom.operators.columns import clean_by_type, require_columns


def sum_streams_by(df: DataFrame, key: str, key_default: str,
                   gen_col: str = "generation", value_col: str = "streams") -> DataFrame:
    """A1/A2: total streams per (generation, key).

    P15 first (text null -> 'unknown', value coerced to BIGINT), then the
    blank-key defaults of the reference's mapper (X10).
    """
    require_columns(df, [gen_col, key, value_col])
    if isinstance(df.schema[value_col].dataType, T.StringType):  # by its role a number, whatever the file says
        df = df.withColumn(value_col, to_int64(value_col))
    slim = clean_by_type(df, [gen_col, key, value_col])
    return slim.groupBy(
        blank_default(gen_col, "unknown").alias("generation"),
        blank_default(key, key_default).alias(key),
    ).agg(F.sum(value_col).alias("total_streams"))


def count_by(df: DataFrame, keys: list[str], name: str = "count", dropna: bool = True) -> DataFrame:
    """A3/A4/A5: row count per key; rows with a null key are dropped like a
    pandas groupby unless ``dropna=False``."""
    require_columns(df, keys)
    if dropna:
        # one IsNotNull per nullable key: Catalyst drops the checks on keys it
        # proves non-null instead of pushing them down as heavy expressions
        nullable = [k for k in keys if df.schema[k].nullable]
        if nullable:
            cond = F.col(nullable[0]).isNotNull()
            for k in nullable[1:]:
                cond = cond & F.col(k).isNotNull()
            df = df.filter(cond)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def min_max(df: DataFrame, cols: list[str]) -> DataFrame:
    """A10: min and max of several columns in one pass."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.agg(*aggs)


def distinct_sorted(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    """A11 (+F8): distinct values in ascending order."""
    out = df.select(col)
    if dropna and df.schema[col].nullable:
        out = out.filter(F.col(col).isNotNull())
    return out.distinct().orderBy(col)


def any_non_null(col: str):
    """A13 as an aggregate expression."""
    return F.coalesce(F.max(F.col(col).isNotNull()), F.lit(False))


def audit_counts(before: DataFrame, year_col: str = "year", lo: int = 1921, hi: int = 2020) -> DataFrame:
    """A12 + A13 as one aggregate pass over the pre-filter rows."""
    y = F.col(year_col)
    return before.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count(y).alias("rows_with_year"),
        F.count_if(y.between(lo, hi)).alias("rows_in_range"),
        any_non_null(year_col).alias("any_year"),
    )


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """A12 without an extra pass: row count collected while the job runs."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def profile_columns(df: DataFrame, roles: dict[str, str]) -> DataFrame:
    """P10 as a table: for every column and each of its roles (``none`` without any) role, column, position,
    rows, nulls, null_share, distinct_estimate (HyperLogLog, within about 5 %).

    One pass with partial aggregates for all columns; ``roles`` gives the
    pattern that a role's column names match in lower case.
    """
    names = df.columns
    flat = df.toDF(*[f"c{i}" for i in range(len(names))])
    sums = [F.struct(F.count(f"c{i}").alias("held"), F.approx_count_distinct(f"c{i}").alias("distinct_estimate")) for i in range(len(names))]
    one = flat.agg(F.count("*").alias("rows"), F.array(*sums).alias("columns"))
    what = F.array(*[F.struct(F.lit(c).alias("column"), F.array(*[F.lit(r) for r, p in roles.items() if re.search(p, c.lower())] or [F.lit("none")]).alias("roles")) for c in names])
    rows = one.select("rows", F.posexplode(F.arrays_zip(what.alias("what"), F.col("columns").alias("found"))).alias("position", "x"))
    nulls = F.col("rows") - F.col("x.found.held")
    return rows.select(F.explode("x.what.roles").alias("role"), F.col("x.what.column").alias("column"), "position", "rows", nulls.alias("nulls"),
                       F.when(F.col("rows") > 0, nulls / F.col("rows")).alias("null_share"), F.col("x.found.distinct_estimate").alias("distinct_estimate"))
