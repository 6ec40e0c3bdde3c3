"""Plans that read their source once, global order, pivots without a second run, the profile table, the entry's guard."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from trendloom.operators import pivots
from trendloom.operators.ordering import global_rank
from trendloom.plans import build, catalog, reports
from trendloom.plans.etl import normalize_tracks, yearly_totals

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parent.parent


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def runs_of_scans(plan: str, columns: str) -> int:
    """Scans with these columns in the parts of a plan that ran, without those reused."""
    final = plan.split("== Initial Plan ==")[0]
    return sum(columns in line and "FileScan" in line for line in final.splitlines())


def test_totals_read_the_catalog_once(spark):
    df = build.top_artists_by_generation(build.catalog_totals(catalog.raw_catalog(spark, SF), "artist", None, ordered=False), ordered=False)
    plan = final_plan(df)
    assert "ReusedExchange" in plan or "ReusedSubquery" in plan
    assert runs_of_scans(plan, "l_orderkey") == 1


RAW = "artist string, platform string, year string, popularity string, x int"


@pytest.mark.parametrize("rows", [
    [("A", "p", "1990", "5", 1), ("A", "p", "1995", "2.5", 1), ("B", None, "2100", "9", 1), (" ", "", "1991", "x", 1), (None, "q", None, "1", 1)],
    [("A", "p", "2100", "5", 1), ("B", "p", "2101", "1", 1), ("B", "q", None, "1", 1)],
    [("A", "p", "1990", "0", 1), ("A", "p", "1991", "x", 1), ("B", "q", "1991", None, 1)],
    [("A", "p", "2100", "0", 1), ("A", "q", "", "0", 1)],
    [("A", "p", "x", "1", 1)],
    [],
])
@pytest.mark.parametrize("popularity", [True, False])
def test_totals_equal_those_of_the_rows(spark, rows, popularity):
    raw = spark.createDataFrame(rows, RAW)
    raw = raw if popularity else raw.drop("popularity")
    tracks = normalize_tracks(raw, platform=None)
    for key, totals in (("artist", build.artist_trends), ("platform", build.generation_stats)):
        want = sorted(map(tuple, totals(tracks).collect()), key=repr)
        assert sorted(map(tuple, build.catalog_totals(raw, key, None).collect()), key=repr) == want
    assert yearly_totals(raw, "platform", "unknown").where("platform <> 'spotify'").count() == 0


def test_global_rank(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v"), (F.col("id") % 3).alias("g")).repartition(7)
    got = global_rank(df, [F.col("g").desc(), F.col("v").asc()]).collect()
    want = sorted(((r.v, r.g) for r in got), key=lambda r: (-r[1], r[0]))
    assert [(r.v, r.g) for r in sorted(got, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in got) == list(range(1, 5001))
    assert global_rank(df.limit(0), [F.col("v").asc()]).collect() == []


def test_pivots_run_what_is_above_them_once(spark):
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    stats = spark.createDataFrame([("1990s", "A", 1), ("1990s", "Z", 99), ("2000s", None, 5)], "generation string, platform string, total_streams long").coalesce(1)
    counted = stats.mapInArrow(seen, stats.schema)
    got = reports.streams_by_decade_platform(counted).collect()
    assert [r.asDict() for r in got] == [{"generation": "1990s", "A": 1, "Z": 99}, {"generation": "2000s", "A": 0, "Z": 0}]
    assert runs.value == 3


def test_pivots_name_their_limit(spark, monkeypatch):
    df = spark.range(20).select(F.lit("x").alias("k"), F.col("id").cast("string").alias("c"), "id")
    with pytest.raises(ValueError, match="more than 10 values"):
        pivots.categories_of(df, "c", 10)


def test_profile_table(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 4 > 0, F.col("id").cast("string")).alias("Artist_Name"), (F.col("id") % 50).alias("play_count"), F.lit("x").alias("song"), F.lit(None).cast("date").alias("year_date"))
    rows = {(r["role"], r["column"]): r for r in reports.profile_table(df).collect()}
    assert set(rows) == {("artist", "Artist_Name"), ("streams", "play_count"), ("track", "song"), ("year", "year_date"), ("date", "year_date")}
    found = rows["artist", "Artist_Name"]
    assert (found.rows, found.nulls, found.null_share) == (3000, 750, 0.25) and abs(found.distinct_estimate - 2250) < 160
    assert abs(rows["streams", "play_count"].distinct_estimate - 50) <= 4 and rows["date", "year_date"].null_share == 1
    assert reports.profile_table(df.limit(0)).where("rows = 0 AND null_share IS NULL").count() == 5


def test_entry_without_the_optional_parts(tmp_path):
    """A leftover of the folder, or a package it needs that is absent, leaves the core's queries."""
    for name in ("__spark_entry__.py", "trendloom"):
        (tmp_path / name).symlink_to(ROOT / name) if name.endswith(".py") else (tmp_path / name).mkdir()
    for part in (ROOT / "trendloom").iterdir():
        if part.name != "llm":
            (tmp_path / "trendloom" / part.name).symlink_to(part)
    (tmp_path / "trendloom" / "llm" / "__pycache__").mkdir(parents=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); print(len(q), any(k.startswith('op') for k in q))"
    (tmp_path / "entry.py").write_text((ROOT / "__spark_entry__.py").read_text())
    done = subprocess.run([sys.executable, "-c", code.replace("__spark_entry__", "entry")], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, check=False)
    n, llm = done.stdout.split() if done.returncode == 0 else (done.stderr, "")
    assert int(n) > 40 and llm == "False"
