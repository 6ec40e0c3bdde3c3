"""Readers (S1-S8).

Raw catalogs are read all-string (no schema inference job); typing happens in
the cleaning expressions. Sniffing touches only the header; bytes that are no
UTF-8 are told in the pass that parses them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.functions.numeric import to_double
from trendloom.operators.filters import parse_key_value_lines
from trendloom.sources import records
from trendloom.sources.layout import COLUMN_TYPES, GENERATION_STATS_FILES, TOP_ARTISTS_FILES, Layout
from trendloom.sources.publish import finished

SEPARATORS = (",", ";", "\t")  # fixed values: candidates, in trial order

# The texts a pandas CSV read turns into missing values.
NA_VALUES = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


class SourceNotFound(FileNotFoundError):
    """The named input does not exist."""


def _missing(e: AnalysisException) -> bool:
    cond = getattr(e, "getCondition", None) or getattr(e, "getErrorClass", None)
    return (cond() if cond else "") == "PATH_NOT_FOUND" or "PATH_NOT_FOUND" in str(e)


def _guard(read: Callable[[], DataFrame], path: str) -> DataFrame:
    try:
        return read()
    except AnalysisException as e:
        if _missing(e):
            raise SourceNotFound(f"input not found: {path}") from e
        raise


def exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a data file; a folder that a failed job left doesn't, nor one of Spark's writers without their mark of success."""
    try:
        files = spark.read.format("text").load(path).inputFiles()
        return bool(files) and finished(spark, path)
    except AnalysisException as e:
        if _missing(e):
            return False
        raise


def sniff_separator(header: str) -> str:
    """First separator that splits the header into at least two fields."""
    for sep in SEPARATORS:
        if len(records.header_names(header, sep)) >= 2:
            return sep
    raise ValueError(f"could not split the header with any of {SEPARATORS!r}: {header[:80]!r}")


def null_vocabulary(df: DataFrame, na_values=NA_VALUES) -> DataFrame:
    """The missing-value vocabulary applied once, to every text column."""
    na = list(na_values)
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            out.append(F.when(c.isin(na), F.lit(None).cast("string")).otherwise(c).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def open_delimited(spark: SparkSession, path: str, sep: str | None = None) -> records.Dialect:
    """The separator and header of S1."""
    return _guard(lambda: records.read_dialect(spark, path, SEPARATORS if sep is None else (sep,)), path)


def parse_delimited(found: DataFrame, dialect: records.Dialect, encoding: str | None = None, na_values=NA_VALUES, info: str | None = None) -> DataFrame:
    """The fields of records, the missing-value texts null, under the header's names as they stand."""
    rows = records.parsed(found, dialect, records.charset(encoding), "_info")
    rows = null_vocabulary(rows, na_values) if na_values else rows
    return rows.toDF(*dialect.names, info) if info else rows.drop("_info").toDF(*dialect.names)


def read_delimited(spark: SparkSession, path: str, sep: str | None = None,
                   encoding: str | None = None, na_values=NA_VALUES,
                   multi_line: bool | None = None, info: str | None = None) -> DataFrame:
    """Delimited text with separator/encoding sniffing, all columns string.

    Names are those of the header, case included; a line equal to the header
    is a header wherever it stands, and blank lines are left out. Quoted line
    breaks stay in their fields: ``multi_line=None`` finds the files that hold
    some by one pass over the lines, False reads each line as a record without
    that pass, True regroups all files. Files stay splittable in any case.

    Without ``encoding`` a record is UTF-8, or Latin-1 where its bytes are no
    UTF-8. ``info`` names a struct column (``records.INFO``) that tells ragged
    records, with their text, and encodings; a short record's missing fields are
    null, a long one's surplus is in that text only.
    """
    dialect = open_delimited(spark, path, sep)
    return parse_delimited(records.read_records(spark, path, dialect, multi_line), dialect, encoding, na_values, info)


def read_sample(spark: SparkSession, path: str, n: int = 2000, sep: str | None = None,
                encoding: str | None = None, na_values=NA_VALUES, multi_line: bool | None = None) -> DataFrame:
    """The first n records, in order of files (by path) and of places in them.

    Reads the first files only, as many as it takes; each task passes on n records at most.
    """
    dialect = open_delimited(spark, path, sep)
    files = sorted(spark.read.format("text").load(path).inputFiles())
    k = 1
    while True:
        first = records.ordered_records(spark, path, dialect, records.spellings(files[:k]), multi_line).orderBy("file", "block", "n").limit(n)
        if k >= len(files) or first.count() == n:
            return parse_delimited(first.select("value"), dialect, encoding, na_values)
        k *= 8


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             types: dict[str, str] | None = None, escape_breaks: bool = False) -> DataFrame:
    """S3: header CSV; declared schema, else text columns (no inference job).

    ``types`` declares some columns by name, wherever they stand: the missing
    values' texts become null (D2), numbers are parsed, and text that is no
    number is null. Columns that aren't named stay text.
    """
    r = spark.read.option("header", True).option("escape", '"')
    if schema is not None:
        r = r.schema(schema)
    df = _guard(lambda: r.csv(path), path)
    if escape_breaks:
        df = df.select(*[_unescaped(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema.fields])
    return typed(df, types) if types is not None else df


def _unescaped(c: Column) -> Column:
    """Undoes ``write_csv``'s escapes; backslash pairs are set aside first (U+0000 can't stand in the text)."""
    c = F.replace(c, F.lit("\\\\"), F.lit("\x00"))
    c = F.replace(F.replace(c, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    return F.replace(c, F.lit("\x00"), F.lit("\\"))


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns by their declared types, the missing-value texts null."""
    df = null_vocabulary(df)
    out = []
    for f in df.schema.fields:
        c, to = F.col(f"`{f.name}`"), types.get(f.name)
        if to in ("bigint", "int"):
            c = F.coalesce(c.try_cast(to), to_double(c, f.dataType).try_cast(to))
        elif to == "double":
            c = to_double(c, f.dataType)
        out.append(c.alias(f.name))
    return df.select(*out)


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """S3 of a named dataset: its numeric columns typed as ``layout.COLUMN_TYPES`` says."""
    return read_csv(spark, path, types=COLUMN_TYPES)


def load_generation_stats(spark: SparkSession, layout: Layout) -> DataFrame | None:
    """S5 of R7: the first candidate file that exists."""
    return read_first_existing(spark, layout.candidates(GENERATION_STATS_FILES))


def load_top_artists(spark: SparkSession, layout: Layout) -> DataFrame | None:
    """S5 of R8: the first candidate file that exists."""
    return read_first_existing(spark, layout.candidates(TOP_ARTISTS_FILES))


def load_enriched(spark: SparkSession, layout: Layout) -> DataFrame:
    """The drill-down's source (R6), typed."""
    return read_dataset(spark, layout.enriched_tracks)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return _guard(lambda: spark.read.parquet(path), path)


def read_parquet_or_csv(spark: SparkSession, parquet_path: str, csv_path: str) -> DataFrame:
    """Parquet when present, else the CSV beside it, else SourceNotFound."""
    if exists(spark, parquet_path):
        return read_parquet(spark, parquet_path)
    if exists(spark, csv_path):
        return read_dataset(spark, csv_path)
    raise SourceNotFound(f"neither {parquet_path} nor {csv_path} exists")


def read_first_existing(spark: SparkSession, paths: list[str],
                        reader: Callable[[SparkSession, str], DataFrame] = read_dataset) -> DataFrame | None:
    """The first candidate path that exists, else None."""
    for p in paths:
        if exists(spark, p):
            return reader(spark, p)
    return None


def read_key_value_lines(spark: SparkSession, path: str, key_names: tuple[str, str],
                         defaults: tuple[str, str]) -> DataFrame:
    """Text lines parsed like the reference mapper (strict comma split)."""
    lines = _guard(lambda: spark.read.format("text").load(path), path)
    return parse_key_value_lines(lines, key_names, defaults)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines with a declared schema (no inference pass)."""
    return _guard(lambda: spark.read.schema(schema).json(path), path)
