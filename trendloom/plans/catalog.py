"""Test-data adapter: the driver's TPC-H-like tables in catalog shape.

``lineitem`` joined to ``part`` gives one catalog row per line item, with
dirty text introduced by deterministic arithmetic that Spark and DuckDB both
express (SURVEY §7.3). Each builder has its SQL twin right below it so the
two stay in step.

Join strategy: no broadcast hint. ``part`` is a dimension that grows with
the scale factor (2 GB at SF 1000), so the choice is left to Spark's
size check (``spark.sql.autoBroadcastJoinThreshold`` on the scan statistics)
and to AQE, which re-plans to a broadcast only when the shuffled part side
proves small and otherwise keeps the sort-merge join (skew-split by AQE).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Genre labels indexed by p_partkey % 16 (FIXTURES §4).
GENRES = [
    "dance pop", "K-Pop", "latin rock", "rap rock", "funk rock", "electro funk",
    "trap latino", "hip hop", "boy band", "Reggaeton", "deep house", "EDM",
    "funk carioca", "jazz", "", None,
]


def _tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag")
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        "p_partkey", "p_name", "p_brand", "p_type")
    return items.join(parts, items.l_partkey == parts.p_partkey, "inner")


def _genre() -> Column:
    # l_partkey equals p_partkey on every joined row; deriving from the
    # lineitem side lets genre predicates run in the scan stage, not the join.
    # A literal array makes the lookup one element_at instead of a CASE chain.
    labels = F.array(*[F.lit(g) if g is not None else F.lit(None).cast("string") for g in GENRES])
    return F.element_at(labels, (F.pmod(F.col("l_partkey"), F.lit(len(GENRES))) + 1).cast("int"))


def _genre_sql() -> str:
    arms = " ".join(
        f"WHEN {i} THEN {repr(g) if g is not None else 'NULL'}" for i, g in enumerate(GENRES))
    return f"CASE p_partkey % 16 {arms} END"


def _year_text(offset: int) -> Column:
    return (F.lit(offset) + F.col("l_orderkey") % 130).cast("string")


def _artists() -> Column:
    lk, ln = F.col("l_orderkey"), F.col("l_linenumber")
    return (F.when(lk % 97 == 0, F.lit(None).cast("string"))
             .when(ln % 5 == 0, F.concat(F.col("p_brand"), F.lit(", "), F.col("p_type")))
             .otherwise(F.concat(F.lit("['"), F.col("p_brand"), F.lit("', '"), F.col("p_type"), F.lit("']"))))


ARTISTS_SQL = ("CASE WHEN l_orderkey % 97 = 0 THEN NULL "
               "WHEN l_linenumber % 5 = 0 THEN p_brand || ', ' || p_type "
               "ELSE '[''' || p_brand || ''', ''' || p_type || ''']' END")


def _name() -> Column:
    return F.when(F.col("l_linenumber") == 2,
                  F.concat(F.lit("\t "), F.col("p_name"), F.lit("  "))).otherwise(F.col("p_name"))


NAME_SQL = "CASE WHEN l_linenumber = 2 THEN chr(9) || ' ' || p_name || '  ' ELSE p_name END"


def _release_date() -> Column:
    y = _year_text(1900)
    return (F.when(F.col("l_orderkey") % 89 == 0, F.lit("n/d"))
             .when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("15/01/"), y))
             .otherwise(F.concat(y, F.lit("-01-15"))))


RELEASE_DATE_SQL = ("CASE WHEN l_orderkey % 89 = 0 THEN 'n/d' "
                    "WHEN l_linenumber % 3 = 0 THEN '15/01/' || CAST(1900 + l_orderkey % 130 AS VARCHAR) "
                    "ELSE CAST(1900 + l_orderkey % 130 AS VARCHAR) || '-01-15' END")


def _popularity(zero: bool) -> Column:
    ln = F.col("l_linenumber")
    if zero:
        return F.when(ln == 6, F.lit("n/a")).otherwise(F.lit("0"))
    q = F.col("l_quantity").cast("int").cast("string")
    return F.when(ln == 6, F.lit("n/a")).when(ln == 4, F.concat(q, F.lit(".5"))).otherwise(q)


def _popularity_sql(zero: bool) -> str:
    if zero:
        return "CASE WHEN l_linenumber = 6 THEN 'n/a' ELSE '0' END"
    q = "CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)"
    return f"CASE WHEN l_linenumber = 6 THEN 'n/a' WHEN l_linenumber = 4 THEN {q} || '.5' ELSE {q} END"


def _comma_artist() -> Column:
    ln = F.col("l_linenumber")
    return (F.when(ln % 4 == 0, F.concat("p_brand", F.lit(', "'), "p_type", F.lit('"')))
             .when(ln % 4 == 1, F.concat("p_type", F.lit(",7"))).otherwise(F.col("p_brand")))


COMMA_ARTIST_SQL = ("CASE WHEN l_linenumber % 4 = 0 THEN p_brand || ', \"' || p_type || '\"' "
                    "WHEN l_linenumber % 4 = 1 THEN p_type || ',7' ELSE p_brand END")


def case_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows whose names differ in case only: artist, Artist, Name, Year, POPULARITY, platform."""
    t = _tables(spark, sf_dir)
    return t.select(F.col("p_brand").alias("artist"), _comma_artist().alias("Artist"), _name().alias("Name"), _year_text(1900).alias("Year"),
                    _popularity(False).alias("POPULARITY"), F.col("l_returnflag").alias("platform"))


def case_catalog_sql() -> str:
    return (f"SELECT {COMMA_ARTIST_SQL} AS artist, {NAME_SQL} AS name, CAST(1900 + l_orderkey % 130 AS VARCHAR) AS year_text, "
            f"{_popularity_sql(False)} AS popularity, l_returnflag AS platform FROM lineitem JOIN part ON l_partkey = p_partkey")


# Fixed value: the header of ``broken_lines``.
BROKEN_HEADER = '"id",note,artist'


def broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text records (``value``) for the raw scan: breaks and quotes in quoted fields, stray quotes in plain ones, ragged rows."""
    t = _tables(spark, sf_dir)
    ln = F.col("l_linenumber")
    note = (F.when(ln == 1, F.concat(F.lit('"'), "p_name", F.lit(',\n""'), "p_type", F.lit('"" \n\nend"')))
             .when(ln == 2, F.concat(F.lit('"\n'), "p_name", F.lit('"')))
             .when(ln == 3, F.concat("p_name", F.lit(' 5" x')))
             .when(ln == 4, F.lit('""'))
             .otherwise(F.col("p_name")))
    tail = F.when(ln == 5, F.concat(F.lit(","), "p_brand", F.lit(",EXTRA"))).when(ln == 6, F.lit("")).otherwise(F.concat(F.lit(","), "p_brand"))
    return t.select(F.concat(F.col("l_orderkey").cast("string"), F.lit(","), note, tail).alias("value"))


def broken_lines_sql() -> str:
    """The fields of ``broken_lines``: id, note, artist, ragged."""
    return ("SELECT CAST(l_orderkey AS VARCHAR) AS id, CASE l_linenumber WHEN 1 THEN p_name || ',' || chr(10) || '\"' || p_type || '\" ' || chr(10) || chr(10) || 'end' "
            "WHEN 2 THEN chr(10) || p_name WHEN 3 THEN p_name || ' 5\" x' WHEN 4 THEN NULL ELSE p_name END AS note, "
            "CASE WHEN l_linenumber = 6 THEN NULL ELSE p_brand END AS artist, "
            "CASE l_linenumber WHEN 5 THEN 'long' WHEN 6 THEN 'short' END AS ragged FROM lineitem JOIN part ON l_partkey = p_partkey")


def raw_catalog(spark: SparkSession, sf_dir: str, variant: str = "standard", keys: bool = False) -> DataFrame:
    """Raw catalog rows: artists, name, release_date|year, popularity, platform, genre, pop (and order_key, line with ``keys``).

    variant 'standard': years 1900-2029 as text dates; 'future': a numeric
    ``year`` column 2100-2229 (none in the catalog window); 'zero': every
    popularity is 0 or 'n/a'.
    """
    t = _tables(spark, sf_dir)
    if variant == "future":
        when_col = ("year", F.when(F.col("l_orderkey") % 89 == 0, F.lit(None).cast("bigint"))
                    .otherwise(F.lit(2100) + F.col("l_orderkey") % 130))
    else:
        when_col = ("release_date", _release_date())
    return t.select(
        _artists().alias("artists"),
        _name().alias("name"),
        when_col[1].alias(when_col[0]),
        _popularity(variant == "zero").alias("popularity"),
        F.col("l_returnflag").alias("platform"),
        _genre().alias("genre"),
        (F.col("l_quantity") * 2).alias("pop"),
        *([F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line")] if keys else []),
    )


def raw_catalog_sql(variant: str = "standard", keys: bool = False) -> str:
    if variant == "future":
        when_sql = "CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE 2100 + l_orderkey % 130 END AS year"
    else:
        when_sql = f"{RELEASE_DATE_SQL} AS release_date"
    return (f"SELECT {ARTISTS_SQL} AS artists, {NAME_SQL} AS name, {when_sql}, "
            f"{_popularity_sql(variant == 'zero')} AS popularity, l_returnflag AS platform, "
            f"{_genre_sql()} AS genre, l_quantity * 2 AS pop {', l_orderkey AS order_key, l_linenumber AS line ' if keys else ''}"
            "FROM lineitem JOIN part ON l_partkey = p_partkey")


def enriched_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched tracks (track_name, artist, year, genre, pop) for the genre jobs."""
    t = _tables(spark, sf_dir)
    return t.select(
        F.col("p_name").alias("track_name"),
        F.col("p_brand").alias("artist"),
        (F.lit(1900) + F.col("l_orderkey") % 130).cast("int").alias("year"),
        _genre().alias("genre"),
        (F.col("l_quantity") * 2).alias("pop"),
    )


def enriched_tracks_sql() -> str:
    return ("SELECT p_name AS track_name, p_brand AS artist, "
            "CAST(1900 + l_orderkey % 130 AS INTEGER) AS year, "
            f"{_genre_sql()} AS genre, l_quantity * 2 AS pop "
            "FROM lineitem JOIN part ON l_partkey = p_partkey")


def key_value_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines for the strict line parser: headers, short lines, embedded
    commas, blank keys and non-integer values mixed with good lines."""
    t = _tables(spark, sf_dir)
    lk, ln = F.col("l_orderkey"), F.col("l_linenumber")
    rd, nm, pop = _release_date(), _name(), _popularity(False)
    value = (F.when(ln == 7, F.lit("generation,artist,streams"))
              .when(lk % 89 == 0, F.concat(rd, F.lit(","), nm))
              .when(ln % 5 == 0, F.concat(rd, F.lit(","), _artists(), F.lit(","), pop))
              .when(lk % 101 == 0, F.concat(rd, F.lit(",,"), pop))
              .otherwise(F.concat(rd, F.lit(","), nm, F.lit(","), pop)))
    return t.select(value.alias("value"))


def key_value_lines_sql() -> str:
    rd, nm, pop = RELEASE_DATE_SQL, NAME_SQL, _popularity_sql(False)
    return ("SELECT CASE WHEN l_linenumber = 7 THEN 'generation,artist,streams' "
            f"WHEN l_orderkey % 89 = 0 THEN ({rd}) || ',' || ({nm}) "
            f"WHEN l_linenumber % 5 = 0 THEN ({rd}) || ',' || ({ARTISTS_SQL}) || ',' || ({pop}) "
            f"WHEN l_orderkey % 101 = 0 THEN ({rd}) || ',,' || ({pop}) "
            f"ELSE ({rd}) || ',' || ({nm}) || ',' || ({pop}) END AS value "
            "FROM lineitem JOIN part ON l_partkey = p_partkey")
