"""A small messy catalog run through the file-level jobs; expected values
were worked out by hand from the reference semantics (FIXTURES §2-§3)."""

import os

from trendloom.plans import build
from trendloom.plans.etl import run_etl
from trendloom.plans.genre_share import genre_share_by_generation
from trendloom.sources.layout import Layout
from trendloom.sources.readers import read_csv, read_parquet

RAW = (
    "id;name;artists;release_date;popularity;genre\n"
    "1;Halo;['Beyoncé'];2008-01-01;80;pop\n"
    "2;  Song A ;['Tyler, The Creator', 'X'];2017;55.9;rap\n"
    "3;Old;['Ancient'];1919-05-05;10;jazz\n"
    "4;Future;['Nova'];2021;20;edm\n"
    "5;Blank;[];1999-12-31;n/a;rock\n"
    "6;Dup;['Beyoncé'];15/06/2003;20;pop\n"
    "7;NoYear;['Z'];unknown;30;pop\n"
    "8;Quoted;\"'Solo, Artist'\";1985;7;funk\n"
)


def _write(path, data: bytes):
    p = path[len("file:"):] if path.startswith("file:") else path
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "wb") as f:
        f.write(data)


def test_messy_catalog_end_to_end(spark, scratch):
    lay = Layout(scratch("fixture"))
    _write(lay.raw_tracks, RAW.encode("latin-1"))
    run_etl(spark, lay.raw_tracks, lay.tracks)
    tracks = read_parquet(spark, lay.tracks)
    got = sorted((r.id, r.artist, r.track_name, r.year, r.streams, r.platform, r.generation)
                 for r in tracks.collect())
    assert got == [
        ("1", "Beyoncé", "Halo", 2008, 80, "spotify", "2000s"),
        ("2", "Tyler, The Creator", "Song A", 2017, 55, "spotify", "2010s"),
        ("5", "", "Blank", 1999, 0, "spotify", "1990s"),
        ("6", "Beyoncé", "Dup", 2003, 20, "spotify", "2000s"),
        ("8", "Solo, Artist", "Quoted", 1985, 7, "spotify", "1980s"),
    ]

    outs = build.run_build(spark, lay)
    stats = read_csv(spark, outs["generation_stats"], "generation string, platform string, total_streams bigint")
    assert [tuple(r) for r in stats.collect()] == [
        ("2000s", "spotify", 100), ("2010s", "spotify", 55), ("1980s", "spotify", 7), ("1990s", "spotify", 0)]
    trends = read_csv(spark, outs["artist_trends"], "generation string, artist string, total_streams bigint")
    assert [tuple(r) for r in trends.collect()] == [
        ("2000s", "Beyoncé", 100), ("2010s", "Tyler, The Creator", 55),
        ("1980s", "Solo, Artist", 7), ("1990s", "Unknown Artist", 0)]
    top = read_csv(spark, outs["top_artists_by_gen"], "generation string, artist string, total_streams bigint")
    assert sorted(map(tuple, top.collect())) == sorted(map(tuple, trends.collect()))

    strict = build.artist_trends(tracks, strict_line_split=True)
    assert [tuple(r) for r in strict.collect()] == [("2000s", "Beyoncé", 100), ("1990s", "Unknown Artist", 0)]

    share = genre_share_by_generation(tracks).collect()
    by_gen = {r.generation: r.asDict() for r in share}
    assert by_gen["2000s"]["Pop"] == 100.0 and by_gen["2010s"]["Rap"] == 100.0
    assert by_gen["1990s"]["Rock"] == 100.0 and by_gen["1980s"]["Funk"] == 100.0
    assert by_gen["2000s"]["Rock"] == 0.0
