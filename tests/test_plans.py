"""End-to-end jobs over the driver's sf0.001 tables: invariants and plan shape."""

import duckdb
import pytest

from trendloom.plans import build, catalog, catalog_jobs, reports
from trendloom.plans.etl import normalize_tracks, run_etl
from trendloom.plans.genre_share import genre_share_by_generation, genre_shares, run_genre_share
from trendloom.sources.layout import Layout

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_shares_sum_to_100(spark):
    shares = genre_shares(catalog.enriched_tracks(spark, SF)).collect()
    totals = {}
    for r in shares:
        totals[r.generation] = totals.get(r.generation, 0.0) + r.pct
    assert all(abs(v - 100.0) < 1e-9 for v in totals.values())


def test_pivot_rows_sum_to_100(spark):
    for r in genre_share_by_generation(catalog.enriched_tracks(spark, SF)).collect():
        assert abs(sum(v for k, v in r.asDict().items() if k != "generation") - 100.0) < 1e-9


def test_totals_agree(spark):
    tracks = normalize_tracks(catalog.raw_catalog(spark, SF), platform=None)
    total = tracks.groupBy().sum("streams").collect()[0][0]
    assert build.generation_stats(tracks).groupBy().sum("total_streams").collect()[0][0] == total
    assert build.artist_trends(tracks).groupBy().sum("total_streams").collect()[0][0] == total


def test_top10_bounds(spark):
    tracks = normalize_tracks(catalog.raw_catalog(spark, SF), platform=None)
    trends = build.artist_trends(tracks, ordered=False)
    top = build.top_artists_by_generation(trends).collect()
    per_gen = {}
    for r in top:
        per_gen.setdefault(r.generation, []).append(r.total_streams)
    assert all(len(v) <= 10 for v in per_gen.values())
    for r in trends.collect():
        if r.generation in per_gen and len(per_gen[r.generation]) == 10:
            kept = [t.artist for t in top if t.generation == r.generation]
            if r.artist not in kept:
                assert r.total_streams <= min(per_gen[r.generation])


def test_flagship_plan_shape(spark):
    df = catalog_jobs.q_top10_per_gen(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    df.collect()
    assert "WindowGroupLimit" in plan
    assert "Partial" in plan


@pytest.mark.parametrize("name", sorted(catalog_jobs.JOBS))
def test_no_python_in_plans(spark, name):
    plan = catalog_jobs.JOBS[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "PythonUDF" not in plan


def test_all_jobs_match_sql(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    oracle = __import__("__spark_entry__").oracle_sql()
    failures = []
    for name, sql in ((k, v) for k, v in oracle.items() if k in catalog_jobs.JOBS):
        sdf = catalog_jobs.JOBS[name](spark, SF)
        cols = sorted(sdf.columns)
        srows = sorted((tuple(r[c] for c in cols) for r in sdf.collect()), key=repr)
        rel = con.sql(sql)
        idx = [rel.columns.index(c) for c in cols] if sorted(rel.columns) == cols else None
        if idx is None:
            failures.append((name, "columns", cols, sorted(rel.columns)))
            continue
        drows = sorted((tuple(r[i] for i in idx) for r in rel.fetchall()), key=repr)
        if srows != drows:
            failures.append((name, len(srows), len(drows)))
    assert not failures


def test_entry_smoke(spark):
    entry = __import__("__spark_entry__")
    df = entry.entry(spark)
    assert df.columns == ["generation", "artist", "total_streams"]
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_end_to_end_files(spark, scratch):
    base = Layout(scratch("layout"))
    raw = catalog.raw_catalog(spark, SF)
    (raw.write.mode("overwrite").option("header", True).option("sep", "\t")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(base.raw_tracks))
    run_etl(spark, base.raw_tracks, base.tracks, platform=None)
    outs = build.run_build(spark, base)
    from trendloom.sources.readers import read_csv
    stats = read_csv(spark, outs["generation_stats"], "generation string, platform string, total_streams bigint")
    expected = catalog_jobs.q_gen_platform(spark, SF)
    assert sorted(map(tuple, stats.collect())) == sorted(map(tuple, expected.collect()))
    top = read_csv(spark, outs["top_artists_by_gen"], "generation string, artist string, total_streams bigint")
    assert sorted(map(tuple, top.collect())) == sorted(map(tuple, catalog_jobs.q_top10_per_gen(spark, SF).collect()))
    # Enriched CSV -> fixed-decimal share table
    catalog.enriched_tracks(spark, SF).write.mode("overwrite").option("header", True).csv(base.enriched_tracks)
    share_path = run_genre_share(spark, base)
    share = read_csv(spark, share_path)
    assert share.columns == ["generation", "Electronic", "Funk", "Other", "Pop", "Rap", "Rock"]
    # R1-R4, R7, R8 over the written files
    r1 = reports.streams_by_decade_platform(read_csv(spark, base.generation_stats))
    assert r1.columns[0] == "generation" and r1.count() == stats.select("generation").distinct().count()
    r2 = reports.top_artists_every_decade(read_csv(spark, base.top_artists_by_gen), n=3)
    assert r2.groupBy("generation").count().agg({"count": "max"}).collect()[0][0] <= 3
    assert reports.genre_trend(share, "Missing") is None
    assert reports.genre_trend(share, "Rock").columns == ["generation", "Rock"]
    r7 = reports.metric_trend(read_csv(spark, base.generation_stats, "generation string, platform string, total_streams bigint"))
    assert r7.columns == ["generation", "total_streams"]
    r8 = reports.top_n_one_generation(read_csv(spark, base.artist_trends, "generation string, artist string, total_streams bigint"), "1990s", 5)
    assert r8.count() == 5


def test_profile(spark):
    prof = reports.profile(catalog.raw_catalog(spark, SF), sample_rows=100)
    assert prof.sample.count() == 100 and prof.preview.count() == 5
    assert prof.candidates["streams"] == ["popularity"] and prof.candidates["date"] == ["release_date"]


def test_dashboard_source_and_score_feed(spark):
    src = reports.dashboard_source(catalog.enriched_tracks(spark, SF))
    try:
        counts = reports.drilldown(src, "Rap").yearly_counts
        assert counts.count() > 0
        assert reports.genre_trend_by_year(catalog.enriched_tracks(spark, SF)).columns[0] == "year"
    finally:
        src.unpersist()
    trends = catalog_jobs.q_gen_artist(spark, SF)
    feed = reports.score_feed(trends)
    assert feed.columns == ["artist", "total_streams"]
    assert reports.score_feed(trends.select("generation")) is None


@pytest.mark.parametrize("rows,expect", [
    # normal: in-range years, non-zero popularity -> single pass result
    ([("['A']", "t1", "1990-01-01", "5"), ("['B']", "t2", "2100", "3")], [("A", 1990, 5, "1990s")]),
    # no year in range -> keep every non-null year (clamped label)
    ([("['A']", "t1", "2100", "5"), ("['B']", "t2", "n/d", "3")], [("A", None, 5, "2020s")]),
    # all popularity zero -> every row counts 1
    ([("['A']", "t1", "1990", "0"), ("['B']", "t2", "1995", "n/a")], [("A", 1990, 1, "1990s"), ("B", 1995, 1, "1990s")]),
])
def test_run_etl_guards(spark, scratch, rows, expect):
    base = scratch("etl")
    raw = spark.createDataFrame(rows, "artists string, name string, release_date string, popularity string")
    raw.write.mode("overwrite").option("header", True).csv(base + "/raw")
    out = run_etl(spark, base + "/raw", base + "/tracks.parquet")
    got = sorted((r.artist, r.year, r.streams, r.generation)
                 for r in spark.read.parquet(out).collect())
    if expect[0][1] is None:  # years outside the release-date regex stay null -> compare lazily
        lazy = normalize_tracks(spark.read.option("header", True).csv(base + "/raw"))
        expect = sorted((r.artist, r.year, r.streams, r.generation) for r in lazy.collect())
    assert got == sorted(expect)


def test_run_etl_year_fallback(spark, scratch):
    base = scratch("etl")
    raw = spark.createDataFrame([("A", "t1", "2100", "5"), ("B", "t2", None, "3"), ("C", "t3", "2105", "1")],
                                "artist string, name string, year string, popularity string")
    raw.write.mode("overwrite").option("header", True).csv(base + "/raw")
    out = run_etl(spark, base + "/raw", base + "/tracks.parquet")
    got = sorted((r.artist, r.year, r.generation) for r in spark.read.parquet(out).collect())
    assert got == [("A", 2100, "2020s"), ("C", 2105, "2020s")]


def test_grand_total(spark):
    stats = catalog_jobs.q_gen_platform(spark, SF)
    table = reports.streams_by_decade_platform(stats, ["A", "N", "R"])
    total = reports.grand_total(table).collect()[0].grand_total
    assert total == stats.groupBy().sum("total_streams").collect()[0][0]
