"""Raw catalog -> processed tracks (resolve, clean, filter, label).

Two decisions of the reference depend on the data: an all-zero popularity
column makes every row count 1, and a catalog without a year in range keeps
every row that has a year. ``normalize_tracks`` is one lazy plan and takes both
from one struct-valued scalar subquery over the same input. ``yearly_totals``
sums by year in both readings and decides from the sums, which reads the input
once. ``run_etl`` writes as if neither fires while it observes what decides,
and writes anew only if one does; the target is published when that is settled.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from trendloom.functions.decades import YEAR_MAX, YEAR_MIN, decade_clamped
from trendloom.functions.numeric import to_double
from trendloom.functions.text import blank_default, normalize_text
from trendloom.operators.columns import artist_expr, at_position, name_positions, output_names, track_expr, year_expr, year_position
from trendloom.operators.filters import any_in_range_agg, filter_years_with_fallback, year_in_range

log = logging.getLogger(__name__)

DEFAULT_PLATFORM = "spotify"  # fixed value
#: Why a row is left out: no year given, one that can't be read (D10), one out of range.
NO_YEAR, BAD_YEAR, OUT_OF_RANGE = "no_year", "bad_year", "out_of_range"


@dataclass
class Resolved:
    """Raw columns by position (r0, r1, ...), and the derived ones as expressions on them."""

    rows: DataFrame
    names: list[str]
    derived: dict[str, Column]
    popularity: Column | None
    year_given: Column

    def with_derived(self, *more: str) -> DataFrame:
        """Positions and derived columns (as ``_artist``, ``_year``, ...), and ``_popularity`` if asked for."""
        cols = {f"_{k}": c for k, c in self.derived.items()}
        if "popularity" in more and self.popularity is not None:
            cols["_popularity"] = self.popularity
        return self.rows.withColumns(cols)

    def output(self, df: DataFrame, *more: Column) -> DataFrame:
        """Raw columns under their own names, derived ones in place of those of the very name, else after them; then ``more``."""
        made = [*self.derived, "generation"]
        sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
        out = []
        for i, (raw, name) in enumerate(zip(self.names, output_names(self.names, made, sensitive), strict=True)):
            if name is not None:
                out.append(F.col(f"r{i}").alias(name))
            elif raw in made:
                out.append(F.col(f"_{raw}").alias(raw))
                made.remove(raw)
        return df.select(*out, *[F.col(f"_{m}").alias(m) for m in made], *more)


def resolve(raw: DataFrame, platform: str | None = DEFAULT_PLATFORM) -> Resolved:
    """The catalog's columns by role. Columns are taken by position, so names may differ in case only.

    ``platform=None`` keeps an existing platform column instead of the
    constant (used by the multi-platform test catalog).
    """
    names = list(raw.columns)
    at = lambda i: F.col(f"r{i}")
    found = name_positions(names).get("popularity")
    popularity = None
    if found is not None:
        popularity = F.coalesce(to_double(at(found), raw.schema.fields[found].dataType), F.lit(0.0))
    derived = {
        "artist": normalize_text(artist_expr(raw, at), "Unknown Artist"),
        "track_name": normalize_text(track_expr(raw, at), "Unknown Track"),
        "year": year_expr(raw, at),
        "streams": streams_from(popularity),
    }
    if platform is not None or "platform" not in names:
        derived["platform"] = F.lit(platform or DEFAULT_PLATFORM)
    source = year_position(raw)
    return Resolved(at_position(raw), names, derived, popularity, F.lit(False) if source is None else at(source).isNotNull())


def streams_from(value: Column | None, popularity_total: Column | None = None) -> Column:
    """BIGINT streams; every row counts 1 when the column is absent or
    (given the total) when it sums to 0."""
    if value is None:
        return F.lit(1).cast("bigint")
    streams = F.coalesce(value.try_cast("bigint"), F.lit(0).cast("bigint"))
    if popularity_total is None:
        return streams
    return F.when(popularity_total == 0, F.lit(1).cast("bigint")).otherwise(streams)


def generation_of(year: Column) -> Column:
    return F.coalesce(decade_clamped(year), F.lit("unknown"))


def normalize_tracks(raw: DataFrame, platform: str | None = DEFAULT_PLATFORM,
                     year_range: tuple[int, int] = (YEAR_MIN, YEAR_MAX)) -> DataFrame:
    """Raw columns are kept; artist, track_name, year, streams, platform and
    generation are added (or put in the place of a column of that very name).

    Both data-dependent guards (popularity total, any year in range) come
    from one struct-valued scalar subquery referenced twice, so the input is
    read once for the guards and once for the rows.
    """
    lo, hi = year_range
    r = resolve(raw, platform)
    df = r.with_derived()
    fields = [any_in_range_agg("_year", lo, hi).alias("any_in_range")]
    if r.popularity is not None:
        fields.append(F.sum(r.popularity).alias("popularity_total"))
    guards = df.agg(F.struct(*fields).alias("guards")).scalar()
    if r.popularity is not None:
        df = df.withColumn("_streams", streams_from(r.popularity, guards.getField("popularity_total")))
    df = filter_years_with_fallback(df, "_year", lo, hi, any_in_range=guards.getField("any_in_range"))
    return r.output(df.withColumn("_generation", generation_of(F.col("_year"))))


def yearly_totals(raw: DataFrame, key: str, key_default: str, platform: str | None = DEFAULT_PLATFORM,
                  year_range: tuple[int, int] = (YEAR_MIN, YEAR_MAX)) -> DataFrame:
    """A1/A2 of the normalized tracks in one read of ``raw``: generation, key, total_streams.

    Sums by (year, key) hold both readings: of the streams, and of rows counted
    1. The guards are reduced from these sums, whose shuffle Spark runs once for
    the guards and the totals.
    """
    lo, hi = year_range
    r = resolve(raw, platform)
    value = F.lit(0.0) if r.popularity is None else r.popularity
    by = r.derived[key] if key in r.derived else F.col(f"r{r.names.index(key)}")
    slim = r.rows.select(r.derived["year"].alias("year"), by.alias("key"), r.derived["streams"].alias("streams"), value.alias("popularity"))
    sums = slim.groupBy("year", "key").agg(F.sum("streams").alias("streams"), F.count("*").alias("rows"), F.sum("popularity").alias("popularity"))
    # all sums are used on both sides, so that both are one plan up to the shuffle
    zero = (F.sum("popularity") == 0) & (F.sum("rows") > 0) & F.sum("streams").isNotNull()
    guards = sums.agg(F.struct(any_in_range_agg("year", lo, hi).alias("any_in_range"), zero.alias("zero")).alias("g")).scalar()
    kept = filter_years_with_fallback(sums.where("popularity IS NOT NULL"), "year", lo, hi, any_in_range=guards.getField("any_in_range"))
    text = F.coalesce(F.col("key").cast("string"), F.lit("unknown"))
    kept = kept.select(generation_of(F.col("year")).alias("generation"), text.alias(key), F.when(guards.getField("zero"), F.col("rows")).otherwise(F.col("streams")).alias("streams"))
    return kept.groupBy(blank_default("generation", "unknown").alias("generation"), blank_default(key, key_default).alias(key)).agg(F.sum("streams").alias("total_streams"))


def reject_reason(year: Column, given: Column, lo: int, hi: int, any_in_range: Column) -> Column:
    """Why a row is left out; null if it is kept (F1, F2)."""
    kept = year_in_range(year, lo, hi) | ((any_in_range == 0) & year.isNotNull())
    return F.when(year.isNull(), F.when(given, BAD_YEAR).otherwise(NO_YEAR)).when(~kept, OUT_OF_RANGE)


def audit_etl(raw: DataFrame, info: str | None = None, year_range: tuple[int, int] = (YEAR_MIN, YEAR_MAX)) -> DataFrame:
    """Outcome (kept, rejected), reason, rows, corrupt of what ``normalize_tracks`` does, in one read.

    ``info`` names the reader's struct column; ``corrupt`` counts its records of too many fields.
    """
    lo, hi = year_range
    r = resolve(raw)
    year = r.derived["year"]
    place = F.when(year.isNull(), F.when(r.year_given, BAD_YEAR).otherwise(NO_YEAR)).when(year_in_range(year, lo, hi), "in_range").otherwise(OUT_OF_RANGE)
    bad = F.lit(0) if info is None else F.coalesce((F.col(f"r{r.names.index(info)}.ragged") == "long").cast("int"), F.lit(0))
    counts = r.rows.select(place.alias("place"), bad.alias("bad")).groupBy("place").agg(F.count("*").alias("rows"), F.sum("bad").alias("corrupt"))
    # four rows at most from here on
    in_range = F.max((F.col("place") == "in_range").cast("int")).over(Window.partitionBy(F.lit(0)))
    counts = counts.withColumn("kept", (F.col("place") == "in_range") | ((F.col("place") == OUT_OF_RANGE) & (in_range == 0)))
    reason = F.when(F.col("kept"), "").otherwise(F.col("place"))
    return counts.groupBy(F.when(F.col("kept"), "kept").otherwise("rejected").alias("outcome"), reason.alias("reason")).agg(F.sum("rows").alias("rows"), F.sum("corrupt").alias("corrupt"))


class Written(str):
    """The path that a job wrote, with the counts of the rows it met."""

    counts: dict[str, int]

    @classmethod
    def of(cls, path: str, counts: dict[str, int]) -> Written:
        out = cls(path)
        out.counts = counts
        return out


def run_etl(spark, in_path: str, out_path: str, platform: str | None = DEFAULT_PLATFORM,
            partition_by: list[str] | None = None, encoding: str | None = None,
            rejects_path: str | None = None, multi_line: bool | None = None) -> Written:
    """E1 end to end: sniffed delimited scan -> normalize -> Parquet (CSV fallback).

    One pass in the common case: the output is staged as if each line were a
    record and neither guard fired, while that pass observes what says so
    (lines that leave a quote open, the popularity total, years in range). Where
    it doesn't hold, the staged table is written anew. Only then is the target
    replaced, so readers never see a table that is taken back.

    ``rejects_path`` takes the rows left out, with ``reject_reason`` and, where
    a record has more or fewer fields than the header, its text (``reject_record``);
    the source is read once more for it. Returns the
    path written, with ``counts``: read, kept, rejected (and by reason), corrupt
    (records of too many fields), short, latin_1, utf_8 (not ASCII).

    ``partition_by=["generation"]`` (at most a dozen values) lets later
    per-decade filters read one folder; it is off by default because an
    empty partitioned output has no file to carry the schema.
    """
    from trendloom.sources import publish, records
    from trendloom.sources.readers import open_delimited, parse_delimited
    from trendloom.sources.writers import csv_sibling, write_parquet_safe

    lo, hi = YEAR_MIN, YEAR_MAX
    dialect = open_delimited(spark, in_path)
    told = len(dialect.names)  # the position of the reader's info

    def told_rows(found: DataFrame, zero: bool, fallback: bool):
        r = resolve(found, platform)
        r.names = r.names[:told]
        if zero:
            r.derived["streams"] = F.lit(1).cast("bigint")
        return r, r.with_derived("popularity").withColumn("_reason", reject_reason(F.col("_year"), r.year_given, lo, hi, F.lit(0 if fallback else 1)))

    def attempt(spans: bool | None, zero: bool, fallback: bool) -> tuple[str, dict]:
        lines = records.read_records(spark, in_path, dialect, spans)
        breaks, met = Observation(), Observation()
        if spans is False:
            lines = lines.observe(breaks, F.coalesce(F.max(records.spanning(F.col("value"), dialect.sep).cast("int")), F.lit(0)).alias("open"))
        r, df = told_rows(parse_delimited(lines, dialect, encoding, info="_info"), zero, fallback)
        many = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
        info = F.col(f"r{told}")
        total = F.lit(None).cast("double") if r.popularity is None else F.sum("_popularity")
        df = df.observe(
            met, F.count("*").alias("read"), many(F.col("_reason").isNull()).alias("kept"),
            *[many(F.col("_reason") == x).alias(x) for x in (NO_YEAR, BAD_YEAR, OUT_OF_RANGE)],
            many(info["ragged"] == "long").alias("corrupt"), many(info["ragged"] == "short").alias("short"),
            many(info["latin_1"]).alias("latin_1"), many(info["wide"]).alias("utf_8"),
            any_in_range_agg("_year", lo, hi).alias("any_in_range"), total.alias("popularity_total"))
        df = df.withColumn("_generation", generation_of(F.col("_year")))
        written = write_parquet_safe(r.output(df.where("_reason IS NULL")), publish.staging_path(out_path), partition_by)
        return written, {**met.get, **(breaks.get if spans is False else {})}

    def left_out(spans: bool | None, zero: bool, fallback: bool) -> DataFrame:
        # what is observed keeps the filter above the parser, so that a record is parsed once and only rejects get the other columns
        found = parse_delimited(records.read_records(spark, in_path, dialect, spans), dialect, encoding, info="_info").observe(Observation(), F.count("*").alias("read"))
        r, df = told_rows(found, zero, fallback)
        df = df.withColumn("_generation", generation_of(F.col("_year")))
        return r.output(df.where("_reason IS NOT NULL"), F.col("_reason").alias("reject_reason"), F.col(f"r{told}")["record"].alias("reject_record"))

    spans, zero, fallback = multi_line or False, False, False
    while True:
        staged, seen = attempt(spans, zero, fallback)
        if multi_line is None and spans is False and seen.get("open"):
            spans = None
        else:
            now = (seen["read"] > 0 and seen["popularity_total"] == 0, seen["any_in_range"] == 0 and seen["read"] > seen[NO_YEAR] + seen[BAD_YEAR])
            if now == (zero, fallback):
                break
            zero, fallback = now
        publish.remove(spark, staged)
    counts = {c: seen[c] for c in ("read", "kept", NO_YEAR, BAD_YEAR, OUT_OF_RANGE, "corrupt", "short", "latin_1", "utf_8")}
    counts["rejected"] = counts["read"] - counts["kept"]
    if counts["latin_1"] and counts["utf_8"]:
        log.warning("%s mixes encodings: %d records of UTF-8, %d of Latin-1", in_path, counts["utf_8"], counts["latin_1"])
    if rejects_path is not None:
        write_parquet_safe(left_out(spans, zero, fallback), rejects_path)
    as_csv = staged.endswith(".csv")
    target = csv_sibling(out_path) if as_csv else out_path
    publish.move(spark, staged, target)
    if as_csv:
        publish.remove(spark, out_path)
    return Written.of(target, counts)
