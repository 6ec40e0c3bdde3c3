"""Table-level cases of FIXTURES §3 and operator behaviour."""

import pytest

from trendloom.operators.aggregates import count_by, distinct_sorted, min_max, observed
from trendloom.operators.columns import (
    MissingColumnsError,
    checked_select,
    clean_by_type,
    column_candidates,
    metric_columns,
    name_map,
    pick_column,
    reindex_columns,
    with_generation,
)
from trendloom.operators.filters import (
    equals_filter,
    filter_years_with_fallback,
    parse_key_value_lines,
    range_filter,
)
from trendloom.operators.ordering import order_decades, top_rows
from trendloom.operators.pivots import pivot_table
from trendloom.operators.windows import share_within, top_n_per_group
from trendloom.plans.build import artist_trends, generation_stats, top_artists_by_generation
from trendloom.plans.etl import normalize_tracks


def _years(spark, ys):
    return spark.createDataFrame([(y,) for y in ys], "year int")


def test_year_bounds(spark):
    out = filter_years_with_fallback(_years(spark, [1920, 1921, 2020, 2021, None]))
    assert sorted(r.year for r in out.collect()) == [1921, 2020]


def test_year_fallback_keeps_non_null(spark):
    out = filter_years_with_fallback(_years(spark, [2100, 2101, None]))
    assert sorted(r.year for r in out.collect()) == [2100, 2101]


def test_all_years_null_gives_empty(spark):
    assert filter_years_with_fallback(_years(spark, [None, None])).count() == 0


def test_empty_input(spark):
    assert filter_years_with_fallback(_years(spark, [])).count() == 0


def _raw(spark, rows, schema="artists string, name string, release_date string, popularity string"):
    return spark.createDataFrame(rows, schema)


def test_etl_zero_popularity_counts_one(spark):
    raw = _raw(spark, [("['A']", "t1", "1990-01-01", "0"), ("['B']", "t2", "1995", "n/a")])
    assert [r.streams for r in normalize_tracks(raw).collect()] == [1, 1]


def test_etl_without_popularity_counts_one(spark):
    raw = spark.createDataFrame([("A", "t", "1990")], "artist string, title string, year string")
    out = normalize_tracks(raw).collect()[0]
    assert (out.artist, out.track_name, out.year, out.streams, out.platform, out.generation) == (
        "A", "t", 1990, 1, "spotify", "1990s")


def test_etl_fallback_labels_clamped(spark):
    raw = spark.createDataFrame([("A", "t", 2100), ("B", "u", None)], "artist string, name string, year int")
    out = normalize_tracks(raw).collect()
    assert [(r.year, r.generation) for r in out] == [(2100, "2020s")]


def test_etl_keeps_raw_columns_and_cleans(spark):
    raw = _raw(spark, [(None, "  song\t", "released 1987-05-12", "12.9"),
                       ("['X', 'Y']", None, "n/d", "3")])
    out = normalize_tracks(raw)
    assert out.columns[:4] == ["artists", "name", "release_date", "popularity"]
    rows = out.collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.artist, r.track_name, r.year, r.streams, r.generation) == (
        "Unknown Artist", "song", 1987, 12, "1980s")


def test_blank_key_and_malformed_lines(spark):
    lines = spark.createDataFrame(
        [("generation,artist,streams",), ("1990s,,5",), ("1990s,x",), ("1990s,x,abc",),
         ('1990s,"Tyler, The Creator",5',), ("1990s,y, 7 ",), ("1990s,y,1_0",)], "value string")
    out = parse_key_value_lines(lines, ("generation", "artist"), ("unknown", "Unknown Artist"))
    got = sorted((r.generation, r.artist, r.streams) for r in out.collect())
    assert got == [("1990s", "Unknown Artist", 5), ("1990s", "y", 7), ("1990s", "y", 10)]


def _tracks(spark):
    return spark.createDataFrame(
        [("1990s", "spotify", "Tyler, The Creator", 5), ("1990s", "spotify", "B", 3),
         ("1990s", None, "", 2), (None, "spotify", None, 1)],
        "generation string, platform string, artist string, streams bigint")


def test_embedded_comma_default_vs_strict(spark):
    t = _tracks(spark)
    default = {(r.generation, r.artist): r.total_streams for r in artist_trends(t).collect()}
    strict = {(r.generation, r.artist): r.total_streams for r in artist_trends(t, strict_line_split=True).collect()}
    assert default[("1990s", "Tyler, The Creator")] == 5
    assert ("1990s", "Tyler, The Creator") not in strict
    # blank artist -> 'Unknown Artist'; null artist -> 'unknown' (P15 before X10)
    assert default[("1990s", "Unknown Artist")] == 2 and strict[("1990s", "Unknown Artist")] == 2
    assert default[("unknown", "unknown")] == 1


def test_sums_agree(spark):
    t = _tracks(spark)
    total = sum(r.streams for r in t.collect())
    assert sum(r.total_streams for r in generation_stats(t).collect()) == total
    assert sum(r.total_streams for r in artist_trends(t).collect()) == total


def test_top10_per_generation(spark):
    rows = [("1990s", f"a{i:02d}", i) for i in range(12)] + [("2000s", "z", 1)]
    trends = spark.createDataFrame(rows, "generation string, artist string, total_streams bigint")
    out = top_artists_by_generation(trends).collect()
    g90 = [r for r in out if r.generation == "1990s"]
    assert len(g90) == 10 and min(r.total_streams for r in g90) == 2
    assert [r.total_streams for r in out] == sorted((r.total_streams for r in out), reverse=True)


def test_top_n_ties_break_on_artist(spark):
    trends = spark.createDataFrame([("g", "b", 1), ("g", "a", 1), ("g", "c", 1)],
                                   "generation string, artist string, total_streams bigint")
    out = top_n_per_group(trends, ["generation"], "total_streams", 2, ["artist"])
    assert sorted(r.artist for r in out.collect()) == ["a", "b"]


def test_share_and_pivot(spark):
    counts = spark.createDataFrame([("1990s", "Pop", 3), ("1990s", "Rock", 1)],
                                   "generation string, macro_genre string, count bigint")
    shares = share_within(counts, ["generation"])
    assert sorted((r.macro_genre, r.pct) for r in shares.collect()) == [("Pop", 75.0), ("Rock", 25.0)]
    table = pivot_table(shares, "generation", "macro_genre", "pct",
                        ["Electronic", "Funk", "Other", "Pop", "Rap", "Rock"], fill=0.0).collect()[0]
    assert (table.Pop, table.Rock, table.Funk, table.Other) == (75.0, 25.0, 0.0, 0.0)


def test_missing_column_error(spark):
    df = spark.createDataFrame([("1990s", "a")], "generation string, artist string")
    with pytest.raises(MissingColumnsError, match="streams"):
        artist_trends(df)
    with pytest.raises(MissingColumnsError):
        checked_select(df, ["generation", "total_streams"])


def test_reindex_and_clean(spark):
    df = spark.createDataFrame([("a", None, 2.7), (None, 3, None)], "s string, i int, d double")
    assert reindex_columns(df, ["d", "x", "s"]).columns == ["d", "x", "s"]
    got = [tuple(r) for r in clean_by_type(df).collect()]
    assert got == [("a", 0, 2), ("unknown", 3, 0)]


def test_name_resolution():
    assert name_map(["A ", "b", "a"]) == {"a": "a", "b": "b"}
    assert pick_column(["x", "decade"], ["generation", "geracao", "decade"]) == "decade"
    cands = column_candidates(["Artist Name", "track_title", "release_year", "release_date", "popularity"])
    assert cands["artist"] == ["Artist Name"] and cands["streams"] == ["popularity"]
    assert cands["year"] == ["release_year"] and cands["date"] == ["release_date"]


def test_metric_columns_numeric_only(spark):
    df = spark.createDataFrame([("1990s", "x", 1, 2.0)], "generation string, p string, a bigint, b double")
    assert metric_columns(df, "generation") == ["a", "b"]


def test_with_generation_alternatives(spark):
    df = spark.createDataFrame([(1995,)], "release_year int")
    assert with_generation(df).collect()[0].generation == "1990s"
    df2 = spark.createDataFrame([(1995,)], "other int")
    assert with_generation(df2).collect()[0].generation == "unknown"
    assert with_generation(df, mode="other").collect()[0].generation == "unknown"


def test_range_filter_defaults(spark):
    df = spark.createDataFrame([(10.2,), (45.7,), (None,)], "pop double")
    assert range_filter(df, "pop").count() == 2
    assert range_filter(df, "pop", truncate_bounds=True).count() == 1  # int(45.7)=45 drops 45.7
    assert range_filter(df, "pop", 0, 20).count() == 1


def test_equals_filter_all(spark):
    df = spark.createDataFrame([("a",), ("b",)], "artist string")
    assert equals_filter(df, "artist", "(Todos)").count() == 2
    assert equals_filter(df, "artist", "a").count() == 1


def test_min_max_distinct_counts(spark):
    df = spark.createDataFrame([(1990, "b"), (2000, None), (1990, "a")], "year int, artist string")
    r = min_max(df, ["year"]).collect()[0]
    assert (r.min_year, r.max_year) == (1990, 2000)
    assert [x.artist for x in distinct_sorted(df, "artist").collect()] == ["a", "b"]
    assert sorted(tuple(x) for x in count_by(df, ["artist"]).collect()) == [("a", 1), ("b", 1)]


def test_order_decades(spark):
    df = spark.createDataFrame([("unknown",), ("2000s",), ("1990s",)], "generation string")
    assert [r.generation for r in order_decades(df).collect()] == ["1990s", "2000s", "unknown"]


def test_top_rows_nulls_last(spark):
    df = spark.createDataFrame([("a", None), ("b", 2.0), ("c", 5.0)], "t string, pop double")
    assert [r.t for r in top_rows(df, "pop", 2).collect()] == ["c", "b"]


def test_observed_counts(spark):
    df, obs = observed(spark.range(7), "n")
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 7


def test_isin_and_is_empty(spark):
    from trendloom.operators.filters import is_empty, isin_filter

    df = spark.createDataFrame([("1990s",), ("2000s",), (None,)], "generation string")
    assert [r.generation for r in isin_filter(df, "generation", ["1990s"]).collect()] == ["1990s"]
    assert is_empty(isin_filter(df, "generation", ["1950s"]))
    assert not is_empty(df)
