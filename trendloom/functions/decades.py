"""Year extraction and decade ("generation") labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reference's catalog window and decade clamp.
YEAR_MIN, YEAR_MAX = 1921, 2020
DECADE_FLOOR, DECADE_CEIL = 1920, 2020
YEAR_PATTERN = r"(19\d{2}|20\d{2})"
UNPARSABLE_DECADE_RANK = 9999


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_from_text(c: Column | str) -> Column:
    """First 19xx/20xx run anywhere in the text, as INT (no match -> null)."""
    # the match is four digits or '' (no match), and try_cast('' AS INT) is null
    return F.regexp_extract(_col(c).cast("string"), YEAR_PATTERN, 1).try_cast("int")


def _decade(y: Column) -> Column:
    # floor to the decade; callers only pass years >= 1920, so integer
    # division (which truncates toward zero) equals the floor here
    return (y.cast("bigint") / 10).cast("bigint") * 10


def _as_year(c: Column) -> Column:
    return c.try_cast("bigint")


def decade_clamped(c: Column | str) -> Column:
    """X5: 'unknown' for null, else the decade clamped to 1920s..2020s."""
    y = _as_year(_col(c))
    # clamping the year to [1920, 2029] then flooring equals clamping the decade
    clamped = F.least(F.greatest(y, F.lit(DECADE_FLOOR)), F.lit(DECADE_CEIL + 9))
    label = F.when(y.isNull(), F.lit("unknown")).otherwise(
        F.concat(_decade(clamped).cast("string"), F.lit("s")))
    return F.coalesce(label, F.lit("unknown"))  # never null; lets Catalyst prove it


def decade_open(c: Column | str) -> Column:
    """X6: 'Unknown' for null, 'Before 1920' below 1920, else the decade (no upper clamp)."""
    y = _as_year(_col(c))
    label = (
        F.when(y.isNull(), F.lit("Unknown"))
        .when(y < DECADE_FLOOR, F.lit("Before 1920"))
        .otherwise(F.concat(_decade(y).cast("string"), F.lit("s")))
    )
    return F.coalesce(label, F.lit("Unknown"))  # never null; lets Catalyst prove it


def decade_sort_key(c: Column | str) -> Column:
    """O2: numeric value of a label with every 's' removed; unparsable sorts last."""
    return F.coalesce(
        F.replace(_col(c).cast("string"), F.lit("s"), F.lit("")).try_cast("int"),
        F.lit(UNPARSABLE_DECADE_RANK),
    )
