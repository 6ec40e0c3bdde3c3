"""Readers and writers on files written to the shared scratch folder."""

import os

import pytest

from trendloom.sources.layout import Layout
from trendloom.sources.readers import (
    SourceNotFound,
    exists,
    read_csv,
    read_delimited,
    read_first_existing,
    read_jsonl,
    read_key_value_lines,
    read_parquet_or_csv,
    read_sample,
    sniff_separator,
)
from trendloom.sources.writers import format_decimals, write_csv, write_csv_decimals, write_jsonl, write_parquet_safe


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def _write_text(path, data: bytes):
    p = _local(path)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "wb") as f:
        f.write(data)
    return path


def test_sniff_separator():
    assert sniff_separator("a,b,c") == ","
    assert sniff_separator("a;b") == ";"
    assert sniff_separator("a\tb") == "\t"
    assert sniff_separator('"x;y",z') == ","
    with pytest.raises(ValueError):
        sniff_separator("single")


def test_read_delimited_semicolon_latin1(spark, scratch):
    text = "artists;name;release_date;popularity\n['Beyoncé'];Halo;2008-01-01;80\nNA;x;n/d;n/a\n"
    path = _write_text(scratch("csv") + "/tracks.csv", text.encode("latin-1"))
    df = read_delimited(spark, path)
    rows = df.collect()
    assert df.columns == ["artists", "name", "release_date", "popularity"]
    assert rows[0].artists == "['Beyoncé']"
    assert rows[1].artists is None and rows[1].popularity is None  # NA vocabulary
    assert read_sample(spark, path, n=1).count() == 1


def test_read_delimited_utf8_quoted_comma(spark, scratch):
    text = 'artist,name\n"Tyler, The Creator",x\n'
    path = _write_text(scratch("csv") + "/t.csv", text.encode("utf-8"))
    assert read_delimited(spark, path).collect()[0].artist == "Tyler, The Creator"


def test_missing_source(spark, scratch):
    missing = scratch("nope") + "/x.csv"
    assert not exists(spark, missing)
    with pytest.raises(SourceNotFound):
        read_delimited(spark, missing)
    with pytest.raises(SourceNotFound):
        read_parquet_or_csv(spark, missing + ".parquet", missing)
    assert read_first_existing(spark, [missing]) is None


def test_parquet_then_csv_fallback(spark, scratch):
    base = scratch("pq")
    df = spark.createDataFrame([("1990s", "a", 3)], "generation string, artist string, streams bigint")
    write_csv(df, base + "/tracks.csv")
    got = read_parquet_or_csv(spark, base + "/tracks.parquet", base + "/tracks.csv")
    assert got.collect()[0].artist == "a"
    write_parquet_safe(df, base + "/tracks.parquet")
    got = read_parquet_or_csv(spark, base + "/tracks.parquet", base + "/tracks.csv")
    assert got.schema["streams"].dataType.typeName() == "long"


def test_first_existing(spark, scratch):
    base = scratch("first")
    df = spark.createDataFrame([("1990s", 1)], "generation string, total_streams bigint")
    write_csv(df, base + "/b.csv")
    got = read_first_existing(spark, [base + "/a.csv", base + "/b.csv"])
    assert got is not None and got.count() == 1


def test_csv_roundtrip_quoting(spark, scratch):
    df = spark.createDataFrame([("1990s", 'He said "hi", then', 5)],
                               "generation string, artist string, total_streams bigint")
    path = write_csv(df, scratch("rt"))
    back = read_csv(spark, path, "generation string, artist string, total_streams bigint").collect()[0]
    assert back.artist == 'He said "hi", then' and back.total_streams == 5


def test_fixed_decimals(spark, scratch):
    df = spark.createDataFrame([("1990s", 75.0, 1 / 3)], "generation string, Pop double, Rock double")
    assert [tuple(r) for r in format_decimals(df).collect()] == [("1990s", "75.00", "0.33")]
    path = write_csv_decimals(df, scratch("dec"), single_file=True)
    assert read_csv(spark, path).collect()[0].Rock == "0.33"


def test_jsonl_roundtrip(spark, scratch):
    df = spark.createDataFrame([("1990s", "a", 3)], "generation string, artist string, total_streams bigint")
    path = write_jsonl(df, scratch("json"))
    back = read_jsonl(spark, path, "generation string, artist string, total_streams bigint")
    assert [tuple(r) for r in back.collect()] == [("1990s", "a", 3)]


def test_key_value_lines_from_text(spark, scratch):
    path = _write_text(scratch("lines") + "/part-0", b"generation,artist,streams\n1990s,a,5\n1990s,a,2\nbad\n")
    out = read_key_value_lines(spark, path, ("generation", "artist"), ("unknown", "Unknown Artist"))
    assert sorted(tuple(r) for r in out.collect()) == [("1990s", "a", 2), ("1990s", "a", 5)]


def test_layout():
    lay = Layout("s3a://bucket/base/")
    assert lay.tracks == "s3a://bucket/base/processed/tracks.parquet"
    assert lay.genre_share.endswith("processed/genre_share_by_generation.csv")
