"""Numeric coercions with the reference's forgiving / strict semantics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A decimal number as text: optional sign, digits with optional fraction, optional exponent.
NUMERIC_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Numeric coercion to double: bad text, NaN and null all become null."""
    c = _col(c)
    if dtype is not None and isinstance(dtype, T.NumericType):
        d = c.cast("double")
    else:
        txt = c.cast("string")
        d = F.when(txt.rlike(NUMERIC_TEXT), txt.try_cast("double"))
    return F.nanvl(d, F.lit(None).cast("double"))


def to_int64(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Coerce, null -> 0, truncate toward zero to BIGINT."""
    if dtype is not None and isinstance(dtype, T.IntegralType):
        return F.coalesce(_col(c).cast("bigint"), F.lit(0).cast("bigint"))
    return F.coalesce(to_double(c, dtype).try_cast("bigint"), F.lit(0).cast("bigint"))


def to_nullable_int(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Coerce to a nullable INT; non-integral values become null."""
    d = to_double(c, dtype)
    return F.when(d == F.floor(d), d.try_cast("int"))


def digits_only(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Numeric columns pass through; text keeps its digits only ('' -> 0)."""
    c = _col(c)
    if dtype is not None and isinstance(dtype, T.NumericType):
        return c
    return F.coalesce(
        F.regexp_replace(c.cast("string"), "[^0-9]", "").try_cast("bigint"),
        F.lit(0).cast("bigint"),
    )


def strict_int(c: Column | str, what: str = "value") -> Column:
    """X11: cast to INT and fail the job on null or malformed values."""
    c = _col(c)
    d = c.try_cast("double")  # "1990.0" is whole; a fraction is cut off, as int() of a float does
    v = F.coalesce(c.try_cast("int"), F.when(F.isnan(d), None).otherwise(d).try_cast("int"))
    return F.when(
        v.isNull(), F.raise_error(F.lit(f"cannot convert {what} to int (null or malformed)"))
    ).otherwise(v)
