"""Writers (K1-K5). Every writer overwrites its target (K5), by publishing a finished table in its place."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.sources.publish import published, remove

log = logging.getLogger(__name__)

# Conditions under which Spark refuses to write a type.
UNWRITABLE = ("UNSUPPORTED_DATA_TYPE_FOR_DATASOURCE", "UNSUPPORTED_DATASOURCE_FOR_DATA_TYPE", "INVALID_PARTITION_COLUMN_DATA_TYPE")


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    w = df.write
    if partition_by:
        w = w.partitionBy(*list(partition_by))
    return published(df.sparkSession, path, w.parquet)


def _escaped(c: Column) -> Column:
    for raw, text in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        c = F.replace(c, F.lit(raw), F.lit(text))
    return c


def csv_sibling(path: str) -> str:
    base = path.rstrip("/")
    return (base[: -len(".parquet")] if base.endswith(".parquet") else base) + ".csv"


def write_parquet_safe(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """K1: Parquet, or a CSV beside it when Parquet can't hold a column's type.

    Such a type is refused before anything runs or is written. Failures of the
    data or the job are raised as they are, and nothing is computed twice. In
    the CSV, columns of no simple type are text; an earlier Parquet at ``path``
    goes once the CSV is whole, so that readers (S4) don't take it for the new one.
    """
    try:
        return write_parquet(df, path, partition_by)
    except AnalysisException as e:
        if (e.getCondition() or "").split(".")[0] not in UNWRITABLE:
            raise
        target = csv_sibling(path)
        log.warning("parquet write failed (%s); writing CSV to %s", e, target)
        write_csv(as_text(df), target)
        remove(df.sparkSession, path)
        return target


def as_text(df: DataFrame) -> DataFrame:
    """Columns that a CSV can't hold as text: JSON of arrays, maps and structs, else Spark's own text of the value."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        elif isinstance(f.dataType, (T.NullType, T.CalendarIntervalType, T.VariantType)) or not isinstance(f.dataType, T.AtomicType):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str, single_file: bool = False, escape_breaks: bool = False) -> str:
    """K2: header CSV with RFC-4180 quoting; outer spaces are kept.

    ``escape_breaks`` writes line breaks in text as ``\\n`` and ``\\r`` (and a
    backslash as two), so that every row stays on one line; ``read_csv`` with
    the same flag undoes it, in splits of a file and not one task a file.

    ``single_file`` funnels the rows through one task: use it only for
    outputs of bounded size (report tables with one row per decade).
    """
    out = df.coalesce(1) if single_file else df
    if escape_breaks:
        out = out.select(*[_escaped(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in out.schema.fields])
    w = (out.write.option("header", True).option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    return published(df.sparkSession, path, w.csv)


def format_decimals(df: DataFrame, decimals: int = 2) -> DataFrame:
    """K3 projection: every float column as fixed-decimal text."""
    fmt = f"%.{decimals}f"
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            out.append(F.format_string(fmt, c).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def write_csv_decimals(df: DataFrame, path: str, decimals: int = 2, single_file: bool = False) -> str:
    """K3: CSV with floats written as ``%.{decimals}f``."""
    return write_csv(format_decimals(df, decimals), path, single_file)


def write_jsonl(df: DataFrame, path: str) -> str:
    """K4: one JSON object per line; readers take the whole directory."""
    return published(df.sparkSession, path, df.write.json)
