"""Processed tracks -> generation_stats, artist_trends, top_artists_by_gen.

The reference runs two MapReduce jobs over text files; here both are hash
aggregations over the same scan, and the top 10 per decade is a window
limit over the artist totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trendloom.functions.numeric import to_int64
from trendloom.operators.aggregates import sum_streams_by
from trendloom.operators.columns import clean_by_type, reindex_columns
from trendloom.operators.filters import accepted_line, sum_key_value_lines
from trendloom.operators.ordering import sort_by_total_desc
from trendloom.operators.windows import top_n_per_group
from trendloom.plans.etl import DEFAULT_PLATFORM, yearly_totals

TOP_PER_GENERATION = 10  # fixed value


def _csv_field(c):
    """A text field as pandas' CSV writer quotes it (minimal quoting)."""
    c = c.cast("string")
    return F.when(c.rlike('[,"\\r\\n]'),
                  F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)


def _strict_lines(tracks: DataFrame, key: str, key_default: str) -> DataFrame:
    """D1 strict mode: the reference's CSV hop + comma split, as expressions."""
    slim = clean_by_type(tracks, ["generation", key, "streams"])
    lines = slim.select(F.concat_ws(",", _csv_field(F.col("generation")), _csv_field(F.col(key)),
                                    F.col("streams").cast("string")).alias("value"))
    return sum_key_value_lines(lines, ("generation", key), ("unknown", key_default))


def strict_loss(tracks: DataFrame, key: str) -> Column:
    """Whether the CSV hop and comma split drop a row: its third field is then no integer."""
    text = [F.coalesce(_csv_field(F.col(c)), F.lit("unknown")) for c in ("generation", key)]
    line = F.concat_ws(",", *text, to_int64(F.col("streams"), tracks.schema["streams"].dataType).cast("string"))
    return ~accepted_line(line, "generation,")


def generation_stats(tracks: DataFrame, strict_line_split: bool = False, ordered: bool = True) -> DataFrame:
    """A1 + O1 + P9: generation, platform, total_streams (descending)."""
    agg = (_strict_lines(tracks, "platform", "unknown") if strict_line_split
           else sum_streams_by(tracks, "platform", "unknown"))
    agg = reindex_columns(agg, ["generation", "platform", "total_streams"])
    return sort_by_total_desc(agg, ["generation", "platform"]) if ordered else agg


def artist_trends(tracks: DataFrame, strict_line_split: bool = False, ordered: bool = True) -> DataFrame:
    """A2 + O1 + P9: generation, artist, total_streams (descending)."""
    agg = (_strict_lines(tracks, "artist", "Unknown Artist") if strict_line_split
           else sum_streams_by(tracks, "artist", "Unknown Artist"))
    agg = reindex_columns(agg, ["generation", "artist", "total_streams"])
    return sort_by_total_desc(agg, ["generation", "artist"]) if ordered else agg


def catalog_totals(raw: DataFrame, key: str, platform: str | None = DEFAULT_PLATFORM, ordered: bool = True) -> DataFrame:
    """A1 or A2 straight from a raw catalog, which is read once for the totals and the ETL's guards."""
    default = {"artist": "Unknown Artist"}.get(key, "unknown")
    totals = reindex_columns(yearly_totals(raw, key, default, platform), ["generation", key, "total_streams"])
    return sort_by_total_desc(totals, ["generation", key]) if ordered else totals


def top_artists_by_generation(trends: DataFrame, n: int = TOP_PER_GENERATION,
                              ordered: bool = True) -> DataFrame:
    """The n largest artist totals per generation (ties: artist ascending)."""
    top = top_n_per_group(trends, ["generation"], "total_streams", n, tie_break=["artist"])
    return sort_by_total_desc(top, ["generation", "artist"]) if ordered else top


class Outputs(dict):
    """The paths that a build wrote by name, with the counts of the rows it met."""

    counts: dict[str, int]


def run_build(spark: SparkSession, layout, strict_line_split: bool = False) -> Outputs:
    """E2 end to end over a Layout: read tracks (S4), write the three CSVs (K2).

    The ranking comes from the totals just written, so the tracks are read
    twice (once for each aggregate) and not a third time. ``counts`` of the
    result are observed in these passes: read (tracks), kept and rejected (by
    ``strict_line_split``, in the artists' totals), stats, trends (rows written).
    """
    from trendloom.sources.readers import read_csv, read_parquet_or_csv
    from trendloom.sources.writers import write_csv

    tracks = read_parquet_or_csv(spark, layout.tracks, layout.tracks_csv)
    tracks = tracks.select("generation", "platform", "artist", "streams")
    met, made = Observation(), Observation()
    lost = strict_loss(tracks, "artist") if strict_line_split else F.lit(False)
    seen = tracks.observe(met, F.count("*").alias("read"), F.count_if(lost).alias("rejected"))
    # counted above the sort, whose ranges are sampled by running what is below it once more
    trends = artist_trends(seen, strict_line_split).observe(made, F.count("*").alias("trends"))
    write_csv(trends, layout.artist_trends)
    rows = Observation()
    write_csv(generation_stats(tracks, strict_line_split).observe(rows, F.count("*").alias("stats")), layout.generation_stats)
    totals = read_csv(spark, layout.artist_trends, "generation string, artist string, total_streams bigint")
    write_csv(top_artists_by_generation(totals), layout.top_artists_by_gen)
    out = Outputs(generation_stats=layout.generation_stats, artist_trends=layout.artist_trends, top_artists_by_gen=layout.top_artists_by_gen)
    out.counts = {**met.get, **made.get, **rows.get}
    out.counts["kept"] = out.counts["read"] - out.counts["rejected"]
    return out
