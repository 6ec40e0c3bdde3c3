"""Scalar edge cases of FIXTURES §2, checked value by value."""

import pytest
from pyspark.sql import functions as F

from trendloom.functions import (
    decade_clamped,
    decade_open,
    decade_sort_key,
    digits_only,
    first_artist,
    macro_genre_batch,
    macro_genre_dashboard,
    normalize_text,
    strict_int,
    to_int64,
    to_nullable_int,
    year_from_text,
)


def _apply(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    rows = df.select("i", expr(F.col("v")).alias("out")).orderBy("i").collect()
    return [r.out for r in rows]


FIRST_ARTIST = [
    (None, None),
    ("['A', 'B']", "A"),
    ("[\"Destiny's Child\", 'X']", "Destiny's Child"),
    ("['Tyler, The Creator']", "Tyler, The Creator"),
    ("[' A ']", "A"),
    ("[]", ""),
    ("[None]", "None"),
    ("[1, 2]", "1"),
    ("'solo'", "solo"),
    ("'solo, artist'", "solo, artist"),
    ("'a', 'b'", "a"),
    ('"A" feat B', 'A" feat B'),
    ("[a, b]", "a"),
    ("['']", ""),
    ("Earth, Wind & Fire", "Earth"),
    ("['A'", "A"),
    ("311", "311"),
    ("  ['x', 'y']\t", "x"),
    ("['A'] extra", "A'] extra"),
]


def test_first_artist(spark):
    got = _apply(spark, [v for v, _ in FIRST_ARTIST], first_artist)
    assert got == [e for _, e in FIRST_ARTIST]


def test_year_from_text(spark):
    vals = ["1987-05-12", "12/05/1987", "1987", "12019-01", "1899", "n/d", None, "1899-2001"]
    assert _apply(spark, vals, year_from_text) == [1987, 1987, 1987, 2019, None, None, None, 2001]


def test_numeric_coerce(spark):
    vals = ["12", "12.9", "-12.9", "n/a", None, " 7 ", "1e3", "12d", "NaN", ""]
    assert _apply(spark, vals, to_int64) == [12, 12, -12, 0, 0, 7, 1000, 0, 0, 0]


def test_numeric_coerce_typed(spark):
    assert _apply(spark, [12.9, -3.5, None], lambda c: to_int64(c, __import__("pyspark.sql.types", fromlist=["DoubleType"]).DoubleType()), "double") == [12, -3, 0]


def test_nullable_int(spark):
    assert _apply(spark, ["1999", "1999.0", "1999.5", "x", None], to_nullable_int) == [1999, 1999, None, None, None]


def test_normalize_text(spark):
    vals = [None, "\t A \n", "   ", "B", " C　"]
    assert _apply(spark, vals, lambda c: normalize_text(c, "Unknown Artist")) == [
        "Unknown Artist", "A", "", "B", "C"]


DECADES = [(1899, "1920s", "Before 1920"), (1919, "1920s", "Before 1920"), (1920, "1920s", "1920s"),
           (1999, "1990s", "1990s"), (2020, "2020s", "2020s"), (2031, "2020s", "2030s"),
           (None, "unknown", "Unknown")]


def test_decades(spark):
    years = [y for y, _, _ in DECADES]
    assert _apply(spark, years, decade_clamped, "int") == [c for _, c, _ in DECADES]
    assert _apply(spark, years, decade_open, "int") == [o for _, _, o in DECADES]


GENRES = [
    ("dance pop", "Pop", "Pop"), ("K-Pop", "Pop", "Pop"), ("latin rock", "Rock", "Latin"),
    ("rap rock", "Rock", "Rap"), ("funk rock", "Rock", "Rock"), ("electro funk", "Funk", "Electronic"),
    ("trap latino", "Rap", "Latin"), ("hip hop", "Rap", "Rap"), ("boy band", "Other", "Boy Band"),
    ("Reggaeton", "Other", "Latin"), ("deep house", "Electronic", "Electronic"),
    ("EDM", "Electronic", "Electronic"), ("funk carioca", "Funk", "Funk"), ("jazz", "Other", "Other"),
    ("", "Other", "Other"), (None, "Other", "Other"),
]


def test_macro_genres(spark):
    vals = [g for g, _, _ in GENRES]
    assert _apply(spark, vals, macro_genre_batch) == [b for _, b, _ in GENRES]
    assert _apply(spark, vals, macro_genre_dashboard) == [d for _, _, d in GENRES]


def test_non_text_genre_is_other(spark):
    assert _apply(spark, [1, None], lambda c: macro_genre_batch(c, is_text=False), "int") == ["Other", "Other"]


def test_digits_only(spark):
    assert _apply(spark, ["1,234", "1.5", "-5", "abc", None], digits_only) == [1234, 15, 5, 0, 0]


def test_decade_sort_key(spark):
    assert _apply(spark, ["1990s", "unknown", "Before 1920"], decade_sort_key) == [1990, 9999, 9999]


def test_strict_int_raises_on_null(spark):
    df = spark.createDataFrame([("1999",), (None,)], "v string")
    with pytest.raises(Exception, match="cannot convert"):
        df.select(strict_int("v")).collect()
    ok = spark.createDataFrame([("1999",), (" 2001 ",)], "v string")
    assert [r[0] for r in ok.select(strict_int("v")).collect()] == [1999, 2001]
