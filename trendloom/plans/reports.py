"""The dashboards' tables as DataFrame-returning jobs.

Charts and widgets are not rebuilt; each widget input is a function argument.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.functions.genres import GENRE_RULES_DASHBOARD
from trendloom.functions.numeric import digits_only
from trendloom.operators.aggregates import count_by, distinct_sorted, profile_columns
from trendloom.operators.columns import (
    PROFILE_ROLES,
    checked_select,
    column_candidates,
    metric_columns,
    pick_column,
    subset_columns,
)
from trendloom.operators.filters import equals_filter, range_filter
from trendloom.operators.ordering import order_decades, preview, top_rows, total_order
from trendloom.operators.pivots import pivot_table
from trendloom.operators.windows import top_n_per_group
from trendloom.plans.genre_share import genre_share_by_year, labelled
from trendloom.sources.readers import read_sample

# Candidate column names the dashboards look for.
GENERATION_CANDIDATES = ["generation", "geracao", "decade"]
ARTIST_CANDIDATES = ["artist", "artists", "nome_artista"]
SCORE_CANDIDATES = ["total_streams", "mean_popularity", "popularity", "score", "media_pop"]
DEFAULT_TREND_GENRES = ["Pop", "Rock", "Rap", "Electronic", "Other", "Latin", "Boy Band"]
SLICE_COLUMNS = ["track_name", "artist", "year", "genre", "pop"]
SLICE_TOP = 30


def _clean_totals(df: DataFrame, col: str = "total_streams") -> DataFrame:
    return df.withColumn(col, digits_only(F.col(col), df.schema[col].dataType))


def streams_by_decade_platform(stats: DataFrame, platforms: list[str] | None = None) -> DataFrame:
    """Decade x platform matrix of total streams, decades in numeric order."""
    stats = _clean_totals(checked_select(stats, ["generation", "platform", "total_streams"]))
    table = pivot_table(stats, "generation", "platform", "total_streams", categories=platforms, fill=0)
    return order_decades(table)


def grand_total(table: DataFrame, key: str = "generation") -> DataFrame:
    """A9 check over a pivot: one row with the sum of every value column
    (0 flags a table whose totals were lost, e.g. to a wrong separator)."""
    cols = [c for c in table.columns if c != key]
    total = F.lit(0)
    for c in cols:
        total = total + F.coalesce(F.sum(F.col(f"`{c}`")), F.lit(0))
    return table.agg(total.alias("grand_total"))


def top_artists_every_decade(top: DataFrame, n: int = 10) -> DataFrame:
    """R2: the n best artists of every decade, decades in numeric order."""
    top = _clean_totals(checked_select(top, ["generation", "artist", "total_streams"]))
    best = top_n_per_group(top, ["generation"], "total_streams", n, tie_break=["artist"])
    return order_decades(best, "generation", *total_order(["artist"]))


def genre_composition(share: DataFrame) -> DataFrame:
    """The percentage table ordered by generation label."""
    return share.orderBy("generation")


def genre_trend(share: DataFrame, genre: str) -> DataFrame | None:
    """One genre's share over generations; None when the genre is absent."""
    out = subset_columns(share, "generation", [genre])
    return out.orderBy("generation") if out is not None else None


def genre_trend_by_year(enriched: DataFrame, selected: list[str] | None = None,
                        strict: bool = True) -> DataFrame:
    """Yearly shares for the selected genres (default list, else the first 3)."""
    table = genre_share_by_year(enriched, GENRE_RULES_DASHBOARD, strict)
    genres = [c for c in table.columns if c != "year"]
    if selected is None:
        selected = [g for g in DEFAULT_TREND_GENRES if g in genres] or genres[:3]
    return subset_columns(table, "year", selected)


@dataclass
class Drilldown:
    yearly_counts: DataFrame
    top_tracks: DataFrame


def drilldown(enriched: DataFrame, genre: str, year_range: tuple[int, int] | None = None,
              pop_range: tuple[float, float] | None = None, artist: str | None = None,
              top: int = SLICE_TOP, truncate_bounds: bool = False, strict: bool = True) -> Drilldown:
    """Genre -> year range -> pop range -> artist; yearly counts + top tracks.

    Accepts the raw enriched table or the shared ``dashboard_source`` table.
    """
    table = enriched if "macro_genre" in enriched.columns else labelled(enriched, GENRE_RULES_DASHBOARD, strict)
    sub = equals_filter(table, "macro_genre", genre)
    lo, hi = year_range if year_range else (None, None)
    sub = range_filter(sub, "year", lo, hi, truncate_bounds)
    if "pop" in sub.columns:
        plo, phi = pop_range if pop_range else (None, None)
        sub = range_filter(sub, "pop", plo, phi, truncate_bounds)
    sub = equals_filter(sub, "artist", artist)
    counts = count_by(sub, ["year"], "n_tracks").orderBy("year")
    cols = [c for c in SLICE_COLUMNS if c in sub.columns]
    tracks = top_rows(sub.select(*cols), "pop" if "pop" in cols else cols[0], top)
    return Drilldown(counts, tracks)


def artist_choices(enriched: DataFrame, genre: str, strict: bool = True) -> DataFrame:
    """A11 for the drill-down's artist selector."""
    sub = equals_filter(labelled(enriched, GENRE_RULES_DASHBOARD, strict), "macro_genre", genre)
    return distinct_sorted(sub, "artist")


def dashboard_source(enriched: DataFrame, strict: bool = True, persist: bool = True) -> DataFrame:
    """The labelled table R5 and R6 both read, computed once.

    Persisted MEMORY_AND_DISK: blocks lost with an executor are recomputed
    from lineage, and nothing has to fit in memory.
    """
    table = labelled(enriched, GENRE_RULES_DASHBOARD, strict)
    return table.persist(StorageLevel.MEMORY_AND_DISK) if persist else table


def score_feed(top: DataFrame) -> DataFrame | None:
    """(artist, score) pairs for the ranking chart, detected by name."""
    artist = pick_column(top.columns, ARTIST_CANDIDATES)
    score = pick_column(top.columns, SCORE_CANDIDATES)
    if artist is None or score is None:
        return None
    return top.select(artist, score)


def metric_trend(stats: DataFrame, metrics: list[str] | None = None) -> DataFrame | None:
    """Chosen metric columns over generations; None when no generation column."""
    gen = pick_column(stats.columns, GENERATION_CANDIDATES)
    if gen is None:
        return None
    available = metric_columns(stats, gen, numeric_only=True)
    chosen = metrics if metrics is not None else available[:3]
    return stats.select(gen, *chosen).orderBy(gen)


def top_n_one_generation(top: DataFrame, generation: str, n: int = 10) -> DataFrame | None:
    """Top n rows of one generation by the detected score column."""
    gen = pick_column(top.columns, GENERATION_CANDIDATES)
    artist = pick_column(top.columns, ARTIST_CANDIDATES)
    score = pick_column(top.columns, SCORE_CANDIDATES)
    if not all([gen, artist, score]):
        return None
    sub = equals_filter(top, gen, generation)
    return top_rows(sub, score, max(1, int(n)), tie_break=[c for c in top.columns if c != score])


@dataclass
class Profile:
    columns: list[str]
    sample: DataFrame
    preview: DataFrame
    candidates: dict[str, list[str]]


def profile(raw: DataFrame, sample_rows: int = 2000, preview_rows: int = 5) -> Profile:
    """Column list, a bounded sample (any rows), a preview and per-role candidates."""
    return _profile(raw.limit(sample_rows), preview_rows)


def profile_file(spark: SparkSession, path: str, sample_rows: int = 2000, preview_rows: int = 5) -> Profile:
    """R9 of a delimited file: the sample is its first records."""
    return _profile(read_sample(spark, path, sample_rows), preview_rows)


def _profile(sample: DataFrame, preview_rows: int) -> Profile:
    return Profile(list(sample.columns), sample, preview(sample, preview_rows), column_candidates(list(sample.columns)))


def profile_table(raw: DataFrame) -> DataFrame:
    """P10/R9 over all rows: role, column, position, rows, nulls, null_share, distinct_estimate."""
    return profile_columns(raw, PROFILE_ROLES)
