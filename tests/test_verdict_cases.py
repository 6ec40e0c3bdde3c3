"""Cases in which rows, types or files were once lost without a word."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from trendloom.operators.aggregates import sum_streams_by
from trendloom.operators.filters import range_filter
from trendloom.plans import reports
from trendloom.sources.layout import Layout
from trendloom.sources.readers import exists, load_enriched, load_generation_stats, load_top_artists, read_csv
from trendloom.sources.writers import csv_sibling, write_csv, write_parquet_safe


def test_reports_from_files_are_typed(spark, scratch):
    lay = Layout(scratch("files"))
    top = spark.createDataFrame([("1990s", "A", 9), ("1990s", "B", 100), ("1990s", "C", 50)], "generation string, artist string, total_streams long")
    write_csv(top, lay.artist_trends)
    best = reports.top_n_one_generation(load_top_artists(spark, lay), "1990s", 2)
    assert [tuple(r) for r in best.collect()] == [("1990s", "B", 100), ("1990s", "C", 50)]
    stats = spark.createDataFrame([("1990s", "x", "7"), ("2000s", "x", "n/a"), ("2010s", "x", "8.0")], "generation string, platform string, total_streams string")
    write_csv(stats, lay.generation_stats)
    assert [tuple(r) for r in reports.metric_trend(load_generation_stats(spark, lay)).collect()] == [("1990s", 7), ("2000s", None), ("2010s", 8)]
    rows = [("t", "a", "1990.0", "rock", 10.0), ("u", "None", "1991", "rock", 9.5), ("v", "b", "1991", "rock", None)]
    write_csv(spark.createDataFrame(rows, "track_name string, artist string, year string, genre string, pop double"), lay.enriched_tracks)
    got = reports.drilldown(load_enriched(spark, lay), "Rock")
    assert [tuple(r) for r in got.yearly_counts.collect()] == [(1990, 1), (1991, 1)]
    assert [(r.track_name, r.artist) for r in got.top_tracks.collect()] == [("t", "a"), ("u", None)]


def test_text_streams_are_summed_by_their_role(spark):
    df = spark.createDataFrame([("1990s", "p", "5"), ("1990s", "p", None), ("1990s", "p", "x")], "generation string, platform string, streams string")
    assert [tuple(r) for r in sum_streams_by(df, "platform", "unknown").collect()] == [("1990s", "p", 5)]


def test_nan_does_not_empty_a_range(spark):
    df = spark.createDataFrame([(10.0,), (float("nan"),), (45.7,), (None,)], "pop double")
    assert sorted(r.pop for r in range_filter(df, "pop").collect()) == [10.0, 45.7]
    assert sorted(r.pop for r in range_filter(df, "pop", truncate_bounds=True).collect()) == [10.0]
    assert "Subquery" not in range_filter(df, "pop")._jdf.queryExecution().toString()


def test_platforms_come_from_the_data(spark):
    stats = spark.createDataFrame([("1990s", "A", 1), ("1990s", "Z", 99)], "generation string, platform string, total_streams long")
    assert reports.streams_by_decade_platform(stats).collect()[0].asDict() == {"generation": "1990s", "A": 1, "Z": 99}


@pytest.mark.parametrize("flag", [True, False])
def test_csv_keeps_spaces_and_breaks(spark, scratch, flag):
    rows = [("  lead", 'a "q", \\n', 1), ("x\ny" if flag else "xy", "tail \\", 2), ("\\\\n", None, 3)]
    path = write_csv(spark.createDataFrame(rows, "a string, b string, n int").repartition(1), scratch("csv"), escape_breaks=flag)
    got = read_csv(spark, path, "a string, b string, n int", escape_breaks=flag)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[2]) == rows


def test_failed_jobs_are_not_written_as_csv(spark, scratch):
    path = scratch("bad") + "/bad.parquet"
    bad = spark.range(3).select(F.raise_error(F.lit("bad row")).cast("string").alias("c"))
    with pytest.raises(Exception, match="bad row"):
        write_parquet_safe(bad, path)
    assert not exists(spark, csv_sibling(path)) and not exists(spark, path)
    good = write_parquet_safe(spark.range(3), path)
    assert good == path and exists(spark, path)
