"""Registered jobs over the test catalog, each with its DuckDB SQL twin.

Every job reads the driver's tables (through the adapter in ``catalog``) in
full; the SQL twins re-derive the same catalog from the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.functions.decades import decade_open, year_from_text
from trendloom.functions.genres import GENRE_RULES_BATCH, GENRE_RULES_DASHBOARD, macro_genre
from trendloom.functions.numeric import digits_only, to_int64
from trendloom.functions.text import first_artist, normalize_text
from trendloom.operators.aggregates import audit_counts, distinct_sorted, min_max
from trendloom.operators.columns import clean_by_type, reindex_columns, with_generation
from trendloom.operators.filters import sum_key_value_lines
from trendloom.operators.ordering import decade_order, global_rank, total_order
from trendloom.plans import build, reports
from trendloom.plans.catalog import (
    BROKEN_HEADER,
    broken_lines,
    broken_lines_sql,
    case_catalog,
    case_catalog_sql,
    enriched_tracks,
    enriched_tracks_sql,
    key_value_lines,
    key_value_lines_sql,
    raw_catalog,
    raw_catalog_sql,
)
from trendloom.plans.etl import audit_etl, normalize_tracks
from trendloom.plans.genre_share import (
    genre_counts,
    genre_share_by_generation,
    genre_share_by_year,
    genre_shares,
)

# ---------------------------------------------------------------- Spark side


def _tracks(spark, d, variant="standard", platform=None):
    return normalize_tracks(raw_catalog(spark, d, variant), platform=platform)


def _trends(spark, d):
    return build.catalog_totals(raw_catalog(spark, d), "artist", None, ordered=False)


def _stats(spark, d):
    return build.catalog_totals(raw_catalog(spark, d), "platform", None, ordered=False)


def q_etl_tracks(spark, d):
    return normalize_tracks(raw_catalog(spark, d))


def q_etl_fallback_filter(spark, d):
    return normalize_tracks(raw_catalog(spark, d, "future"))


def q_zero_popularity(spark, d):
    return normalize_tracks(raw_catalog(spark, d, "zero"))


def q_first_artist(spark, d):
    return raw_catalog(spark, d).select("artists", first_artist("artists").alias("first_artist"))


def q_year_extract(spark, d):
    return raw_catalog(spark, d).select("release_date", year_from_text("release_date").alias("year"))


def q_numeric_coerce(spark, d):
    raw = raw_catalog(spark, d)
    base = raw.select("popularity", to_int64("popularity").alias("streams"), "genre", "pop")
    return clean_by_type(base)


def q_text_normalise(spark, d):
    return raw_catalog(spark, d).select(
        "name", normalize_text("name", "Unknown Track").alias("track_name"),
        "artists", normalize_text("artists", "Unknown Artist").alias("artist_text"))


def q_decade_clamped(spark, d):
    raw = raw_catalog(spark, d).select("release_date", year_from_text("release_date").alias("year"))
    return with_generation(raw, "year", "generation", mode="decade")


def q_decade_open(spark, d):
    return enriched_tracks(spark, d).select("year", decade_open("year").alias("generation"))


def q_genre5(spark, d):
    return enriched_tracks(spark, d).select("genre", macro_genre("genre", GENRE_RULES_BATCH).alias("macro_genre"))


def q_genre7(spark, d):
    return enriched_tracks(spark, d).select("genre", macro_genre("genre", GENRE_RULES_DASHBOARD).alias("macro_genre"))


def q_digits_only(spark, d):
    return raw_catalog(spark, d).select(
        "release_date", digits_only("release_date").alias("release_digits"),
        "popularity", digits_only("popularity").alias("popularity_digits"))


def q_reject_malformed(spark, d):
    return sum_key_value_lines(key_value_lines(spark, d), ("generation", "artist"),
                               ("unknown", "Unknown Artist"))


def q_min_max(spark, d):
    return min_max(enriched_tracks(spark, d), ["year", "pop"])


def q_distinct_artists(spark, d):
    return distinct_sorted(enriched_tracks(spark, d), "artist")


def q_audit_counts(spark, d):
    raw = raw_catalog(spark, d)
    return audit_counts(raw.withColumn("year", year_from_text("release_date")))


def q_profile_sample(spark, d):
    """R9 of a file: the first 2000 records of the catalog written in order."""
    from trendloom.sources.writers import write_csv
    raw = raw_catalog(spark, d, keys=True)
    first = ["order_key", "line"]
    path = write_csv(raw.orderBy(*first, *[c for c in raw.columns if c not in first]), _roundtrip_dir(spark, "sample"))
    return reports.profile_file(spark, path).sample


def q_profile_columns(spark, d):
    return reports.profile_table(raw_catalog(spark, d)).drop("distinct_estimate")


def q_etl_audit(spark, d):
    return audit_etl(raw_catalog(spark, d))


def q_etl_audit_fallback(spark, d):
    return audit_etl(raw_catalog(spark, d, "future"))


def q_etl_case_variants(spark, d):
    return normalize_tracks(case_catalog(spark, d), platform=None)


def _broken_file(spark, d):
    """Records with breaks and ragged ones as text files; the header stands in a file of its own, first by name."""
    base = _roundtrip_dir(spark, "broken")
    spark.range(1).select(F.lit(BROKEN_HEADER)).write.text(f"{base}/0-header")
    broken_lines(spark, d).write.text(f"{base}/1-rows")
    return f"{base}/*"


def q_records_with_breaks(spark, d):
    """Every record of files with quoted breaks and ragged rows."""
    from trendloom.sources.readers import read_delimited
    rows = read_delimited(spark, _broken_file(spark, d), info="told")
    return rows.select("id", "note", "artist", F.col("told.ragged").alias("ragged"))


def _etl_file(spark, d, variant="standard"):
    from trendloom.sources.writers import write_csv
    return write_csv(raw_catalog(spark, d, variant), _roundtrip_dir(spark, "etl"))


def q_run_etl_counts(spark, d):
    """A12 of a file-level run: what it read, kept and rejected, as it wrote."""
    from trendloom.plans.etl import run_etl
    out = run_etl(spark, _etl_file(spark, d), _roundtrip_dir(spark, "etl-out") + "/tracks.parquet")
    return spark.createDataFrame(sorted(out.counts.items()), "name string, rows long")


def q_run_etl_rejects(spark, d):
    """the rows that a file-level run left out, and why."""
    from trendloom.plans.etl import run_etl
    base = _roundtrip_dir(spark, "etl-out")
    run_etl(spark, _etl_file(spark, d), base + "/tracks.parquet", rejects_path=base + "/rejects.parquet")
    return spark.read.parquet(base + "/rejects.parquet").select("name", "release_date", "year", "streams", "reject_reason")


def q_strict_commas(spark, d):
    """D1 where artists hold commas: the strict build loses them."""
    return build.artist_trends(normalize_tracks(case_catalog(spark, d), platform=None), strict_line_split=True, ordered=False)


def q_build_strict_counts(spark, d):
    """D1 counted: what a strict build over files read, kept and lost."""
    from trendloom.sources.layout import Layout
    from trendloom.sources.writers import write_parquet
    lay = Layout(_roundtrip_dir(spark, "layout"))
    write_parquet(normalize_tracks(case_catalog(spark, d), platform=None), lay.tracks)
    return spark.createDataFrame(sorted(build.run_build(spark, lay, strict_line_split=True).counts.items()), "name string, rows long")


def q_rank_totals(spark, d):
    """O1: every artist total by its place in the descending order."""
    return global_rank(_trends(spark, d), total_order(["generation", "artist"]))


def q_rank_platform_totals(spark, d):
    return global_rank(_stats(spark, d), total_order(["generation", "platform"]))


def q_rank_decades(spark, d):
    """O2 and O3: decades of the platform matrix in numeric order."""
    return global_rank(reports.streams_by_decade_platform(_stats(spark, d)), decade_order())


def q_rank_top_artists(spark, d):
    """The order of R2's rows: decades, then totals."""
    return global_rank(reports.top_artists_every_decade(_trends(spark, d), n=5), [*decade_order(), *total_order(["artist"])])


def q_rank_genre_composition(spark, d):
    """Generations in order of their labels."""
    return global_rank(reports.genre_composition(genre_share_by_generation(enriched_tracks(spark, d))), [F.col("generation").asc()])


def q_rank_slice_years(spark, d):
    """The years of a slice in order."""
    counts = reports.drilldown(enriched_tracks(spark, d), "Latin", pop_range=(10, 90)).yearly_counts
    return global_rank(counts, [F.col("year").asc()])


def q_top10_per_gen(spark, d):
    return build.top_artists_by_generation(_trends(spark, d))


def q_top_n_per_gen(spark, d):
    return reports.top_artists_every_decade(_trends(spark, d), n=5)


def q_top30_slice(spark, d):
    return reports.drilldown(enriched_tracks(spark, d), "Rock", year_range=(1950, 2000)).top_tracks


def q_slice_year_counts(spark, d):
    return reports.drilldown(enriched_tracks(spark, d), "Latin", pop_range=(10, 90)).yearly_counts


def q_slice_artist_counts(spark, d):
    return reports.drilldown(enriched_tracks(spark, d), "Pop", year_range=(1930, 1990),
                             artist="Brand#13").yearly_counts


def q_top_n_one_gen(spark, d):
    return reports.top_n_one_generation(_trends(spark, d), "1990s", n=10)


def q_gen_platform(spark, d):
    return build.catalog_totals(raw_catalog(spark, d), "platform", None)


def q_gen_artist(spark, d):
    return build.catalog_totals(raw_catalog(spark, d), "artist", None)


def q_gen_artist_tracks(spark, d):
    """A2 over normalized rows, as a table of tracks gives it."""
    return build.artist_trends(_tracks(spark, d))


def q_zero_totals(spark, d):
    """A9 in the totals: every popularity is 0, so rows are counted."""
    return build.catalog_totals(raw_catalog(spark, d, "zero"), "artist", None)


def q_fallback_totals(spark, d):
    """F2 in the totals: no year is in range, so all years count."""
    return build.catalog_totals(raw_catalog(spark, d, "future"), "platform", None)


def q_gen_platform_pivot(spark, d):
    return reports.streams_by_decade_platform(_stats(spark, d))


def q_genre_counts_gen(spark, d):
    return genre_counts(enriched_tracks(spark, d))


def q_genre_share_gen(spark, d):
    return genre_shares(enriched_tracks(spark, d))


def q_genre_share_pivot(spark, d):
    return genre_share_by_generation(enriched_tracks(spark, d))


def q_genre_share_year_pivot(spark, d):
    return genre_share_by_year(enriched_tracks(spark, d))


def q_genre_trend(spark, d):
    return reports.genre_trend(genre_share_by_generation(enriched_tracks(spark, d)), "Rock")


def q_genre_trend_year(spark, d):
    return reports.genre_trend_by_year(enriched_tracks(spark, d))


def q_metric_trend(spark, d):
    return reports.metric_trend(_stats(spark, d))


def q_null_extend(spark, d):
    return reindex_columns(_trends(spark, d), ["generation", "platform", "artist", "total_streams"])


def q_strict_gen_artist(spark, d):
    return build.artist_trends(_tracks(spark, d), strict_line_split=True, ordered=False)


def _roundtrip_dir(spark, name):
    from trendloom.session import scratch_path
    return scratch_path(spark, name)


def q_csv_roundtrip(spark, d):
    from trendloom.sources.readers import read_csv
    from trendloom.sources.writers import write_csv
    path = write_csv(_stats(spark, d), _roundtrip_dir(spark, "csv"))
    return read_csv(spark, path, "generation string, platform string, total_streams bigint")


def q_jsonl_roundtrip(spark, d):
    from trendloom.sources.readers import read_jsonl
    from trendloom.sources.writers import write_jsonl
    path = write_jsonl(_trends(spark, d), _roundtrip_dir(spark, "jsonl"))
    return read_jsonl(spark, path, "generation string, artist string, total_streams bigint")


def q_etl_from_csv(spark, d):
    from trendloom.sources.readers import read_delimited
    path = _roundtrip_dir(spark, "rawcsv")
    (raw_catalog(spark, d).write.mode("overwrite").option("header", True).option("sep", ";")
        .option("escape", '"').option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False).csv(path))
    tracks = normalize_tracks(read_delimited(spark, path), platform=None)
    return build.artist_trends(tracks, ordered=False)


def q_gen_platform_strict(spark, d):
    return build.generation_stats(_tracks(spark, d), strict_line_split=True, ordered=False)


def q_genre_composition(spark, d):
    return reports.genre_composition(genre_share_by_generation(enriched_tracks(spark, d)))


def q_artist_choices(spark, d):
    return reports.artist_choices(enriched_tracks(spark, d), "Rap")


def q_score_feed(spark, d):
    return reports.score_feed(reports.top_n_one_generation(_trends(spark, d), "2000s", n=15))


def q_parquet_roundtrip(spark, d):
    from trendloom.sources.readers import read_parquet_or_csv
    from trendloom.sources.writers import write_parquet_safe
    base = _roundtrip_dir(spark, "parquet")
    write_parquet_safe(_tracks(spark, d), base + "/tracks.parquet", partition_by=["generation"])
    tracks = read_parquet_or_csv(spark, base + "/tracks.parquet", base + "/tracks.csv")
    return build.generation_stats(tracks, ordered=False)


def q_build_files(spark, d):
    from trendloom.sources.layout import Layout
    from trendloom.sources.readers import read_csv
    from trendloom.sources.writers import write_parquet
    lay = Layout(_roundtrip_dir(spark, "layout"))
    write_parquet(_tracks(spark, d), lay.tracks)
    outs = build.run_build(spark, lay)
    return read_csv(spark, outs["top_artists_by_gen"], "generation string, artist string, total_streams bigint")


def _written(spark, layout, **frames):
    from trendloom.sources.writers import write_csv
    for name, df in frames.items():
        write_csv(df, getattr(layout, name))
    return layout


def q_metric_trend_files(spark, d):
    from trendloom.sources.layout import Layout
    from trendloom.sources.readers import load_generation_stats
    lay = _written(spark, Layout(_roundtrip_dir(spark, "r7")), generation_stats=_stats(spark, d))
    return reports.metric_trend(load_generation_stats(spark, lay))


def q_top_n_one_gen_files(spark, d):
    from trendloom.sources.layout import Layout
    from trendloom.sources.readers import load_top_artists
    lay = _written(spark, Layout(_roundtrip_dir(spark, "r8")), artist_trends=_trends(spark, d))
    return reports.top_n_one_generation(load_top_artists(spark, lay), "1990s", n=10)


def q_slice_year_counts_file(spark, d):
    from trendloom.sources.layout import Layout
    from trendloom.sources.readers import load_enriched
    lay = _written(spark, Layout(_roundtrip_dir(spark, "r6")), enriched_tracks=enriched_tracks(spark, d))
    return reports.drilldown(load_enriched(spark, lay), "Latin", pop_range=(10, 90)).yearly_counts


def q_csv_breaks_roundtrip(spark, d):
    from trendloom.sources.readers import read_csv
    from trendloom.sources.writers import write_csv
    parts = spark.read.parquet(f"{d}/part.parquet")
    text = F.concat(F.lit('  "'), "p_name", F.lit('", \n'), "p_type", F.lit("\\n\r\n "), "p_brand", F.lit(" "))
    path = write_csv(parts.select("p_partkey", text.alias("note")), _roundtrip_dir(spark, "breaks"), escape_breaks=True)
    return read_csv(spark, path, "p_partkey bigint, note string", escape_breaks=True)


JOBS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in globals().items() if name.startswith("q_") and callable(fn)
}

# ------------------------------------------------------------------ SQL side


def _x1(c):
    """The first name of a list literal, else the text before the first comma."""
    return (rf"CASE WHEN {c} LIKE '[''%'']' THEN regexp_extract({c}, '^\[''([^'']*)''', 1) "
            f"ELSE trim(regexp_extract({c}, '^[^,]*')) END")


def _x4(c, default):
    return rf"regexp_replace(coalesce({c}, '{default}'), '^\s+|\s+$', '', 'g')"


def _x2(c):
    return rf"TRY_CAST(NULLIF(regexp_extract({c}, '(19\d{{2}}|20\d{{2}})', 1), '') AS INTEGER)"


def _num(c):
    return rf"regexp_full_match({c}, '\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*')"


def _x3(c):
    return f"coalesce(CAST(trunc(CASE WHEN {_num(c)} THEN TRY_CAST({c} AS DOUBLE) END) AS BIGINT), 0)"


def _x5(y):
    return (f"CASE WHEN {y} IS NULL THEN 'unknown' ELSE "
            f"CAST(least(greatest({y} - {y} % 10, 1920), 2020) AS VARCHAR) || 's' END")


def _x6(y):
    return (f"CASE WHEN {y} IS NULL THEN 'Unknown' WHEN {y} < 1920 THEN 'Before 1920' "
            f"ELSE CAST({y} - {y} % 10 AS VARCHAR) || 's' END")


def _x9(c):
    return f"coalesce(TRY_CAST(regexp_replace({c}, '[^0-9]', '', 'g') AS BIGINT), 0)"


def _batch_genre(c):
    """The batch job's rules, restated as patterns."""
    return (f"CASE WHEN {c} ILIKE '%pop%' THEN 'Pop' WHEN {c} ILIKE '%rock%' THEN 'Rock' "
            f"WHEN regexp_matches({c}, 'hip hop|rap', 'i') THEN 'Rap' WHEN {c} ILIKE '%funk%' THEN 'Funk' "
            f"WHEN regexp_matches({c}, 'electro|house|techno|edm|dance', 'i') THEN 'Electronic' ELSE 'Other' END")


def _dashboard_genre(c):
    return (f"CASE WHEN {c} ILIKE '%pop%' THEN 'Pop' WHEN regexp_matches({c}, 'latin|reggaeton|salsa|bachata', 'i') THEN 'Latin' "
            f"WHEN regexp_matches({c}, 'boy ?band', 'i') THEN 'Boy Band' WHEN regexp_matches({c}, 'hip hop|rap', 'i') THEN 'Rap' "
            f"WHEN {c} ILIKE '%rock%' THEN 'Rock' WHEN regexp_matches({c}, 'electro|house|techno|edm|dance', 'i') THEN 'Electronic' "
            f"WHEN {c} ILIKE '%funk%' THEN 'Funk' ELSE 'Other' END")


def _etl_sql(variant="standard", keep_platform=False):
    raw = raw_catalog_sql(variant)
    if variant == "future":
        dd = "TRY_CAST(year AS DOUBLE)"
        year = f"CAST(CASE WHEN {dd} = floor({dd}) THEN {dd} END AS INTEGER)"
        date_col = ""
    else:
        year = _x2("release_date")
        date_col = "release_date, "
    platform = "platform" if keep_platform else "'spotify'"
    return f"""
raw AS ({raw}),
tot AS (SELECT sum(coalesce(CASE WHEN {_num('popularity')} THEN TRY_CAST(popularity AS DOUBLE) END, 0)) AS s FROM raw),
d AS (SELECT artists, name, {date_col}popularity, {platform} AS platform, genre, pop,
        {_x4(_x1('artists'), 'Unknown Artist')} AS artist,
        {_x4('name', 'Unknown Track')} AS track_name,
        {year} AS year,
        CASE WHEN (SELECT s FROM tot) = 0 THEN CAST(1 AS BIGINT) ELSE {_x3('popularity')} END AS streams
      FROM raw),
f AS (SELECT * FROM d WHERE year BETWEEN 1921 AND 2020
        OR ((SELECT coalesce(max(CASE WHEN year BETWEEN 1921 AND 2020 THEN 1 ELSE 0 END), 0) FROM d) = 0
            AND year IS NOT NULL)),
etl AS (SELECT *, {_x5('year')} AS generation FROM f)"""


def _sum_by_sql(key, default):
    return (f"SELECT coalesce(nullif(coalesce(generation, 'unknown'), ''), 'unknown') AS generation, "
            f"coalesce(nullif(coalesce({key}, 'unknown'), ''), '{default}') AS {key}, "
            f"CAST(sum(streams) AS BIGINT) AS total_streams FROM etl GROUP BY 1, 2")


TRENDS = "WITH " + _etl_sql(keep_platform=True) + ",\ntrends AS (" + _sum_by_sql("artist", "Unknown Artist") + ")\n"
STATS = "WITH " + _etl_sql(keep_platform=True) + ",\nstats AS (" + _sum_by_sql("platform", "unknown") + ")\n"
ENRICHED = f"WITH enriched AS ({enriched_tracks_sql()})\n"
RAW = f"WITH raw AS ({raw_catalog_sql()})\n"

LABELLED_BATCH = (ENRICHED + f", lab AS (SELECT *, {_x6('year')} AS generation, "
                  f"{_batch_genre('genre')} AS macro_genre FROM enriched)\n")
LABELLED_DASH = (ENRICHED + f", lab AS (SELECT *, {_x6('year')} AS generation, "
                 f"{_dashboard_genre('genre')} AS macro_genre FROM enriched)\n")

SHARES_GEN = LABELLED_BATCH + """, c AS (SELECT generation, macro_genre, count(*) AS count FROM lab GROUP BY 1, 2),
s AS (SELECT *, CAST(sum(count) OVER (PARTITION BY generation) AS BIGINT) AS total FROM c),
p AS (SELECT *, count / total * 100 AS pct FROM s)
"""
SHARES_YEAR = LABELLED_DASH + """, c AS (SELECT year, macro_genre, count(*) AS count FROM lab GROUP BY 1, 2),
s AS (SELECT *, CAST(sum(count) OVER (PARTITION BY year) AS BIGINT) AS total FROM c),
p AS (SELECT *, count / total * 100 AS pct FROM s)
"""


def _pivot_cols(labels, key):
    return ", ".join(f"coalesce(sum(CASE WHEN macro_genre = '{g}' THEN pct END), 0.0) AS \"{g}\""
                     for g in labels)


BATCH_LABELS = ["Electronic", "Funk", "Other", "Pop", "Rap", "Rock"]
DASH_LABELS = ["Boy Band", "Electronic", "Funk", "Latin", "Other", "Pop", "Rap", "Rock"]
TREND_DEFAULT = ["Pop", "Rock", "Rap", "Electronic", "Other", "Latin", "Boy Band"]


def _slice_sql(genre, year_lo=None, year_hi=None, pop_lo=None, pop_hi=None):
    """R6 slice: genre, then year range (default floor/ceil of data), then pop range."""
    s1 = f"s1 AS (SELECT * FROM lab WHERE macro_genre = '{genre}')"
    ylo = year_lo if year_lo is not None else "(SELECT floor(min(year)) FROM s1)"
    yhi = year_hi if year_hi is not None else "(SELECT ceil(max(year)) FROM s1)"
    s2 = f"s2 AS (SELECT * FROM s1 WHERE year BETWEEN {ylo} AND {yhi})"
    plo = pop_lo if pop_lo is not None else "(SELECT floor(min(pop)) FROM s2)"
    phi = pop_hi if pop_hi is not None else "(SELECT ceil(max(pop)) FROM s2)"
    s3 = f"s3 AS (SELECT * FROM s2 WHERE pop BETWEEN {plo} AND {phi})"
    return LABELLED_DASH + f", {s1}, {s2}, {s3}\n"


ORACLE: dict[str, str] = {
    "q_etl_tracks": "WITH " + _etl_sql() + "\nSELECT * FROM etl",
    "q_etl_fallback_filter": "WITH " + _etl_sql("future") + "\nSELECT * FROM etl",
    "q_zero_popularity": "WITH " + _etl_sql("zero") + "\nSELECT * FROM etl",
    "q_first_artist": RAW + f"SELECT artists, {_x1('artists')} AS first_artist FROM raw",
    "q_year_extract": RAW + f"SELECT release_date, {_x2('release_date')} AS year FROM raw",
    "q_numeric_coerce": RAW + (f"SELECT coalesce(popularity, 'unknown') AS popularity, {_x3('popularity')} AS streams, "
                               "coalesce(genre, 'unknown') AS genre, CAST(trunc(pop) AS BIGINT) AS pop FROM raw"),
    "q_text_normalise": RAW + (f"SELECT name, {_x4('name', 'Unknown Track')} AS track_name, artists, "
                               f"{_x4('artists', 'Unknown Artist')} AS artist_text FROM raw"),
    "q_decade_clamped": RAW + (f"SELECT release_date, {_x2('release_date')} AS year, "
                               f"{_x5(_x2('release_date'))} AS generation FROM raw"),
    "q_decade_open": ENRICHED + f"SELECT year, {_x6('year')} AS generation FROM enriched",
    "q_genre5": ENRICHED + f"SELECT genre, {_batch_genre('genre')} AS macro_genre FROM enriched",
    "q_genre7": ENRICHED + f"SELECT genre, {_dashboard_genre('genre')} AS macro_genre FROM enriched",
    "q_digits_only": RAW + (f"SELECT release_date, {_x9('release_date')} AS release_digits, popularity, "
                            f"{_x9('popularity')} AS popularity_digits FROM raw"),
    "q_reject_malformed": f"""WITH lines AS ({key_value_lines_sql()}),
p AS (SELECT value, string_split(value, ',') AS parts FROM lines)
SELECT coalesce(nullif(parts[1], ''), 'unknown') AS generation,
       coalesce(nullif(parts[2], ''), 'Unknown Artist') AS artist,
       CAST(sum(CAST(regexp_replace(parts[3], '[\\s_]', '', 'g') AS BIGINT)) AS BIGINT) AS total_streams
FROM p
WHERE NOT starts_with(value, 'generation,') AND len(parts) >= 3
  AND regexp_full_match(parts[3], '\\s*[+-]?[0-9]+(_[0-9]+)*\\s*')
GROUP BY 1, 2""",
    "q_min_max": ENRICHED + ("SELECT min(year) AS min_year, max(year) AS max_year, "
                             "min(pop) AS min_pop, max(pop) AS max_pop FROM enriched"),
    "q_distinct_artists": ENRICHED + "SELECT DISTINCT artist FROM enriched WHERE artist IS NOT NULL",
    "q_audit_counts": RAW + (f", y AS (SELECT {_x2('release_date')} AS year FROM raw)\n"
                             "SELECT count(*) AS rows_in, count(year) AS rows_with_year, "
                             "CAST(count_if(year BETWEEN 1921 AND 2020) AS BIGINT) AS rows_in_range, "
                             "coalesce(bool_or(year IS NOT NULL), false) AS any_year FROM y"),
    "q_top10_per_gen": TRENDS + """, r AS (SELECT *, row_number() OVER (PARTITION BY generation
        ORDER BY total_streams DESC NULLS LAST, artist ASC) AS rn FROM trends)
SELECT generation, artist, total_streams FROM r WHERE rn <= 10""",
    "q_top_n_per_gen": TRENDS + """, r AS (SELECT *, row_number() OVER (PARTITION BY generation
        ORDER BY total_streams DESC NULLS LAST, artist ASC) AS rn FROM trends)
SELECT generation, artist, total_streams FROM r WHERE rn <= 5""",
    "q_top30_slice": _slice_sql("Rock", 1950, 2000) + """SELECT track_name, artist, year, genre, pop FROM s3
ORDER BY pop DESC NULLS LAST, track_name, artist, year, genre LIMIT 30""",
    "q_slice_year_counts": _slice_sql("Latin", None, None, 10, 90) + """SELECT year, count(*) AS n_tracks
FROM s3 WHERE year IS NOT NULL GROUP BY year""",
    "q_slice_artist_counts": _slice_sql("Pop", 1930, 1990) + """SELECT year, count(*) AS n_tracks
FROM s3 WHERE artist = 'Brand#13' AND year IS NOT NULL GROUP BY year""",
    "q_top_n_one_gen": TRENDS + """SELECT generation, artist, total_streams FROM trends WHERE generation = '1990s'
ORDER BY total_streams DESC NULLS LAST, generation, artist LIMIT 10""",
    "q_gen_platform": STATS + "SELECT * FROM stats",
    "q_gen_artist": TRENDS + "SELECT * FROM trends",
    "q_gen_platform_pivot": STATS + """SELECT generation,
  CAST(coalesce(sum(CASE WHEN platform = 'A' THEN total_streams END), 0) AS BIGINT) AS "A",
  CAST(coalesce(sum(CASE WHEN platform = 'N' THEN total_streams END), 0) AS BIGINT) AS "N",
  CAST(coalesce(sum(CASE WHEN platform = 'R' THEN total_streams END), 0) AS BIGINT) AS "R"
FROM stats GROUP BY generation""",
    "q_genre_counts_gen": LABELLED_BATCH + "SELECT generation, macro_genre, count(*) AS count FROM lab GROUP BY 1, 2",
    "q_genre_share_gen": SHARES_GEN + "SELECT generation, macro_genre, count, total, pct FROM p",
    "q_genre_share_pivot": SHARES_GEN + f"SELECT generation, {_pivot_cols(BATCH_LABELS, 'generation')} FROM p GROUP BY generation",
    "q_genre_share_year_pivot": SHARES_YEAR + f"SELECT CAST(year AS VARCHAR) AS year, {_pivot_cols(DASH_LABELS, 'year')} FROM p GROUP BY year",
    "q_genre_trend": SHARES_GEN + "SELECT generation, coalesce(sum(CASE WHEN macro_genre = 'Rock' THEN pct END), 0.0) AS \"Rock\" FROM p GROUP BY generation",
    "q_genre_trend_year": SHARES_YEAR + "SELECT CAST(year AS VARCHAR) AS year, " + ", ".join(
        f"coalesce(sum(CASE WHEN macro_genre = '{g}' THEN pct END), 0.0) AS \"{g}\"" for g in TREND_DEFAULT)
        + " FROM p GROUP BY year",
    "q_metric_trend": STATS + "SELECT generation, total_streams FROM stats",
    "q_null_extend": TRENDS + "SELECT generation, CAST(NULL AS VARCHAR) AS platform, artist, total_streams FROM trends",
    "q_strict_gen_artist": TRENDS + "SELECT * FROM trends",
    "q_metric_trend_files": STATS + "SELECT generation, total_streams FROM stats",
    "q_top_n_one_gen_files": TRENDS + """SELECT generation, artist, total_streams FROM trends WHERE generation = '1990s'
ORDER BY total_streams DESC NULLS LAST, generation, artist LIMIT 10""",
    "q_slice_year_counts_file": _slice_sql("Latin", None, None, 10, 90) + """SELECT year, count(*) AS n_tracks
FROM s3 WHERE year IS NOT NULL GROUP BY year""",
    "q_csv_breaks_roundtrip": """SELECT p_partkey::BIGINT AS p_partkey,
'  "' || p_name || '", ' || chr(10) || p_type || chr(92) || 'n' || chr(13) || chr(10) || ' ' || p_brand || ' ' AS note FROM part""",
    "q_csv_roundtrip": STATS + "SELECT * FROM stats",
    "q_jsonl_roundtrip": TRENDS + "SELECT * FROM trends",
    "q_etl_from_csv": TRENDS + "SELECT * FROM trends",
    "q_gen_platform_strict": STATS + "SELECT * FROM stats",
    "q_genre_composition": SHARES_GEN + f"SELECT generation, {_pivot_cols(BATCH_LABELS, 'generation')} FROM p GROUP BY generation",
    "q_artist_choices": LABELLED_DASH + "SELECT DISTINCT artist FROM lab WHERE macro_genre = 'Rap' AND artist IS NOT NULL",
    "q_score_feed": TRENDS + """SELECT artist, total_streams FROM trends WHERE generation = '2000s'
ORDER BY total_streams DESC NULLS LAST, generation, artist LIMIT 15""",
    "q_parquet_roundtrip": STATS + "SELECT * FROM stats",
    "q_profile_sample": f"""WITH raw AS ({raw_catalog_sql(keys=True)})
SELECT artists, name, release_date, nullif(popularity, 'n/a') AS popularity, platform, nullif(genre, '') AS genre,
  CAST(pop AS VARCHAR) AS pop, CAST(order_key AS VARCHAR) AS order_key, CAST(line AS VARCHAR) AS line
FROM raw ORDER BY raw.order_key, raw.line, raw.artists NULLS FIRST, raw.name, raw.release_date, raw.popularity, raw.platform,
  raw.genre NULLS FIRST, raw.pop LIMIT 2000""",
    "q_profile_columns": RAW + """, c AS (SELECT count(*) AS rows, count(artists) AS artists, count(name) AS name, count(release_date) AS release_date,
  count(popularity) AS popularity, count(platform) AS platform, count(genre) AS genre, count(pop) AS pop FROM raw),
u AS (SELECT 'artist' AS role, 'artists' AS "column", 0 AS position, rows, rows - artists AS nulls FROM c
  UNION ALL SELECT 'none', 'name', 1, rows, rows - name FROM c UNION ALL SELECT 'date', 'release_date', 2, rows, rows - release_date FROM c
  UNION ALL SELECT 'streams', 'popularity', 3, rows, rows - popularity FROM c UNION ALL SELECT 'none', 'platform', 4, rows, rows - platform FROM c
  UNION ALL SELECT 'none', 'genre', 5, rows, rows - genre FROM c UNION ALL SELECT 'none', 'pop', 6, rows, rows - pop FROM c)
SELECT *, nulls / rows AS null_share FROM u""",
    "q_etl_audit": RAW + (f", y AS (SELECT {_x2('release_date')} AS year FROM raw)\n"
                          "SELECT CASE WHEN year BETWEEN 1921 AND 2020 THEN 'kept' ELSE 'rejected' END AS outcome, "
                          "CASE WHEN year IS NULL THEN 'bad_year' WHEN year BETWEEN 1921 AND 2020 THEN '' ELSE 'out_of_range' END AS reason, "
                          "count(*) AS rows, 0::BIGINT AS corrupt FROM y GROUP BY 1, 2"),
    "q_etl_audit_fallback": """WITH y AS (SELECT l_orderkey % 89 = 0 AS none FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT CASE WHEN none THEN 'rejected' ELSE 'kept' END AS outcome, CASE WHEN none THEN 'no_year' ELSE '' END AS reason,
  count(*) AS rows, 0::BIGINT AS corrupt FROM y GROUP BY 1, 2""",
    "q_etl_case_variants": f"""WITH raw AS ({case_catalog_sql()}), t AS (SELECT *, CAST(year_text AS INTEGER) AS year FROM raw)
SELECT trim(artist) AS artist, artist AS "Artist_raw", name AS "Name", year_text AS "Year_raw", popularity AS "POPULARITY", platform,
  {_x4('name', 'Unknown Track')} AS track_name, year, {_x3('popularity')} AS streams, {_x5('year')} AS generation
FROM t WHERE year BETWEEN 1921 AND 2020""",
    "q_records_with_breaks": broken_lines_sql(),
    "q_run_etl_counts": RAW + f""", y AS (SELECT {_x2('release_date')} AS year FROM raw),
c AS (SELECT count(*) AS n, count(year) AS has, count_if(year BETWEEN 1921 AND 2020) AS good FROM y)
SELECT unnest(['read', 'kept', 'rejected', 'no_year', 'bad_year', 'out_of_range', 'corrupt', 'short', 'latin_1', 'utf_8']) AS name,
  unnest([n, good::BIGINT, n - good::BIGINT, 0, n - has, has - good::BIGINT, 0, 0, 0, 0]) AS rows FROM c""",
    "q_run_etl_rejects": RAW + f""", y AS (SELECT name, release_date, {_x2('release_date')} AS year, {_x3('popularity')} AS streams FROM raw)
SELECT *, CASE WHEN year IS NULL THEN 'bad_year' ELSE 'out_of_range' END AS reject_reason FROM y
WHERE year IS NULL OR year NOT BETWEEN 1921 AND 2020""",
    "q_strict_commas": f"""WITH raw AS ({case_catalog_sql()}), t AS (SELECT *, CAST(year_text AS INTEGER) AS year FROM raw)
SELECT {_x5('year')} AS generation, trim(artist) AS artist, CAST(sum({_x3('popularity')}) AS BIGINT) AS total_streams
FROM t WHERE year BETWEEN 1921 AND 2020 AND NOT contains(artist, ',') GROUP BY 1, 2""",
    "q_build_strict_counts": f"""WITH raw AS ({case_catalog_sql()}), t AS (SELECT *, CAST(year_text AS INTEGER) AS year FROM raw),
k AS (SELECT *, {_x5('year')} AS generation, contains(artist, ',') AS lost FROM t WHERE year BETWEEN 1921 AND 2020)
SELECT unnest(['read', 'rejected', 'kept', 'trends', 'stats']) AS name, unnest([count(*), count_if(lost)::BIGINT, count_if(NOT lost)::BIGINT,
  count(DISTINCT CASE WHEN NOT lost THEN generation || '|' || artist END), count(DISTINCT generation || '|' || platform)]) AS rows FROM k""",
    "q_rank_totals": TRENDS + """SELECT *, row_number() OVER (ORDER BY total_streams DESC NULLS LAST, generation, artist) AS rank FROM trends""",
    "q_rank_platform_totals": STATS + """SELECT *, row_number() OVER (ORDER BY total_streams DESC NULLS LAST, generation, platform) AS rank FROM stats""",
    "q_rank_decades": STATS + """SELECT generation,
  CAST(coalesce(sum(CASE WHEN platform = 'A' THEN total_streams END), 0) AS BIGINT) AS "A",
  CAST(coalesce(sum(CASE WHEN platform = 'N' THEN total_streams END), 0) AS BIGINT) AS "N",
  CAST(coalesce(sum(CASE WHEN platform = 'R' THEN total_streams END), 0) AS BIGINT) AS "R",
  row_number() OVER (ORDER BY TRY_CAST(left(generation, 4) AS INTEGER) NULLS LAST, generation) AS rank
FROM stats GROUP BY generation""",
    "q_rank_top_artists": TRENDS + """, r AS (SELECT *, row_number() OVER (PARTITION BY generation
        ORDER BY total_streams DESC NULLS LAST, artist ASC) AS rn FROM trends)
SELECT generation, artist, total_streams, row_number() OVER (ORDER BY TRY_CAST(left(generation, 4) AS INTEGER) NULLS LAST, generation,
  total_streams DESC, artist) AS rank FROM r WHERE rn <= 5""",
    "q_rank_genre_composition": SHARES_GEN + f"SELECT generation, {_pivot_cols(BATCH_LABELS, 'generation')}, row_number() OVER (ORDER BY generation) AS rank FROM p GROUP BY generation",
    "q_rank_slice_years": _slice_sql("Latin", None, None, 10, 90) + """, n AS (SELECT year, count(*) AS n_tracks
FROM s3 WHERE year IS NOT NULL GROUP BY year) SELECT *, row_number() OVER (ORDER BY year) AS rank FROM n""",
    "q_gen_artist_tracks": TRENDS + "SELECT * FROM trends",
    "q_zero_totals": "WITH " + _etl_sql("zero", keep_platform=True) + "\n" + _sum_by_sql("artist", "Unknown Artist"),
    "q_fallback_totals": "WITH " + _etl_sql("future", keep_platform=True) + "\n" + _sum_by_sql("platform", "unknown"),
    "q_build_files": TRENDS + """, r AS (SELECT *, row_number() OVER (PARTITION BY generation
        ORDER BY total_streams DESC NULLS LAST, artist ASC) AS rn FROM trends)
SELECT generation, artist, total_streams FROM r WHERE rn <= 10""",
}
