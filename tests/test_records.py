"""The raw scan: records over several lines, ragged rows, encodings, headers; checked against pandas or the csv module."""

from __future__ import annotations

import csv
import io
import itertools
import random

import pytest
from pyspark.sql import functions as F

from trendloom.operators.columns import output_names
from trendloom.plans.etl import audit_etl, normalize_tracks, run_etl
from trendloom.sources import publish, records
from trendloom.sources.readers import exists, read_delimited, read_parquet_or_csv, read_sample
from trendloom.sources.writers import csv_sibling, write_parquet_safe


@pytest.fixture()
def text_file(spark, scratch):
    """Writes bytes as a file under the scratch folder; more names make a folder of files."""

    def make(**files: bytes) -> str:
        fs = spark.sparkContext._jvm.org.apache.hadoop.fs
        base = scratch("text")
        for name, data in files.items():
            path = fs.Path(f"{base}/{name}.csv")
            out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
            out.write(bytearray(data))
            out.close()
        return base

    return make


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plain(data: bytes, sep=",", encoding="utf-8"):
    """Header and rows as the csv module reads them, short rows filled, empty fields null."""
    head, *rows = [r for r in csv.reader(io.StringIO(data.decode(encoding), newline=""), delimiter=sep) if any(f.strip() for f in r)]
    return head, sorted((tuple((r[i] if i < len(r) and r[i] != "" else None) for i in range(len(head))) for r in rows), key=repr)


QUOTED = b'id,note,artist\n1,"two\nlines",A\n2,plain,B\n3,"a ""quote"" and\n\nthree, lines",C\n4,5" vinyl,D\n5,"x"y"z,E\n6,"",F\n7,"end\n",G\n'


@pytest.mark.parametrize("multi_line", [None, True])
def test_records_over_lines(spark, text_file, multi_line):
    head, rows = plain(QUOTED)
    got = read_delimited(spark, text_file(a=QUOTED), multi_line=multi_line)
    apart = lambda rs: [r for r in rs if r[0] != "5"]  # noqa: E731  what follows a closing quote is kept, quotes and all
    assert got.columns == head and apart(rows_of(got)) == apart(rows) and got.where("id = '5' AND artist = 'E'").count() == 1


def test_crlf_and_blank_lines(spark, text_file):
    data = b'id,note\r\n1,"two\r\nlines"\r\n\r\n   \r\n2,x\r\n3,"last"'
    got = rows_of(read_delimited(spark, text_file(a=data)))
    assert got == [("1", "two\r\nlines"), ("2", "x"), ("3", "last")]


def test_files_with_and_without_breaks_are_one_table(spark, text_file):
    path = text_file(a=QUOTED, b=b"id,note,artist\n8,x,H\n9,y,I\n", c=b"", d=b'id,note,artist\n10,"p\nq",J\n')
    got = read_delimited(spark, path)
    assert sorted(int(r.id) for r in got.collect()) == list(range(1, 11))
    assert {r.note for r in got.where("id = '10'").collect()} == {"p\nq"}


@pytest.mark.parametrize("seed", range(2))
def test_records_cut_at_any_place(spark, text_file, seed):
    """Random quoted text in splits of a few bytes: states must compose over lines and blocks."""
    rng = random.Random(seed)
    pieces = ["a", "b c", "\n", '""', ",", "x\ny", "", '"",""']
    rows = []
    for i in range(60):
        if rng.random() < 0.5:
            rows.append(f'{i},"{"".join(rng.choice(pieces) for _ in range(rng.randrange(6)))}",z{i}')
        else:
            rows.append(f'{i},w{rng.randrange(9)}{rng.choice(["", chr(34)])},z{i}')
    data = ("id,note,last\n" + "\n".join(rows) + "\n").encode()
    path = text_file(a=data, b=b"id,note,last\n100,x,y\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in before:
        spark.conf.set(k, "32")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 10
        got = read_delimited(spark, path, na_values=("",))
        want = plain(data)[1]
        assert rows_of(got.where("id <> '100'")) == want
        sample = read_sample(spark, path, 25, na_values=("",)).collect()
        assert [int(r.id) for r in sample] == list(range(25))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_stray_quote_takes_no_whole_file(spark, text_file, monkeypatch):
    monkeypatch.setattr(records, "MAX_RECORD_LINES", 50)
    data = b"id,note\n" + b"".join(b'%d,"%s\n' % (i, b"open" if i == 5 else b'x"') for i in range(400))
    got = read_delimited(spark, text_file(a=data), info="told")
    ids = {r.id for r in got.collect() if r.id and r.id.isdigit()}
    assert len(ids) > 390


def test_ragged_rows_are_kept_and_told(spark, text_file):
    data = b'artist,name,year\nA,"x\ny",1990\nB,t,1991,EXTRA,MORE\nC,u\nD,"v,""w""",1992,"p,q"\n'
    got = {r.artist: r for r in read_delimited(spark, text_file(a=data), info="told").collect()}
    assert {a: r.told.ragged for a, r in got.items()} == {"A": None, "B": "long", "C": "short", "D": "long"}
    assert got["B"].year == "1991" and got["B"].told.record == "B,t,1991,EXTRA,MORE" and got["C"].year is None
    assert read_delimited(spark, text_file(a=data)).columns == ["artist", "name", "year"]


def test_encodings_are_told_by_record(spark, text_file, scratch):
    utf, latin = "Á,é,1990\n".encode(), "Ö,ü,1991\n".encode("latin-1")
    head = b"artist,name,year\n"
    assert rows_of(read_delimited(spark, text_file(a=head + utf))) == [("Á", "é", "1990")]
    assert rows_of(read_delimited(spark, text_file(a=head + latin))) == [("Ö", "ü", "1991")]
    mixed = text_file(a=head + utf + latin)
    assert rows_of(read_delimited(spark, mixed)) == [("Á", "é", "1990"), ("Ö", "ü", "1991")]
    assert rows_of(read_delimited(spark, mixed, encoding="latin-1"))[1][0] == "Ö"
    with pytest.raises(ValueError, match="encoding"):
        read_delimited(spark, mixed, encoding="utf-16")
    counts = run_etl(spark, mixed, scratch("out") + "/t.parquet").counts
    assert (counts["latin_1"], counts["utf_8"], counts["read"]) == (1, 1, 2)


def test_headers(spark, text_file):
    got = read_delimited(spark, text_file(a=b"a,a,A,\n1,2,3,4\na,a,A,\n5,6,7,8\n"))
    assert got.columns == ["a", "a.1", "A", "Unnamed: 3"] and rows_of(got) == [("1", "2", "3", "4"), ("5", "6", "7", "8")]
    got = read_delimited(spark, text_file(a=b'"first\nname";x\n1;2\n'))
    assert got.columns == ["first\nname", "x"] and rows_of(got) == [("1", "2")]
    with pytest.raises(ValueError, match="empty"):
        read_delimited(spark, text_file(a=b""))
    with pytest.raises(ValueError, match="split"):
        read_delimited(spark, text_file(a=b"one\n1\n"))


def test_names_that_differ_in_case(spark, text_file, scratch):
    data = b"artist,Artist,name,Year\nA1,A2,t,1990\nB1,B2,u,1850\n"
    out = normalize_tracks(read_delimited(spark, text_file(a=data)))
    assert out.columns == ["artist", "Artist_raw", "name", "Year_raw", "track_name", "year", "streams", "platform", "generation"]
    assert rows_of(out) == [("A2", "A2", "t", "1990", "t", 1990, 1, "spotify", "1990s")]
    written = run_etl(spark, text_file(a=data), scratch("case") + "/t.parquet")
    assert rows_of(spark.read.parquet(written)) == rows_of(out)
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert normalize_tracks(read_delimited(spark, text_file(a=data))).columns[:4] == ["artist", "Artist", "name", "Year"]
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")
    assert output_names(["x", "X", "X_raw", "Y"], ["y"], False) == ["x", "X_raw", "X_raw_raw", "Y_raw"]


# ---- counts and publishing

CATALOG = b'artists,name,release_date,popularity\n"[\'A\']",t,1990,5\n"[\'B\']","u\nv",2050,3\n"[\'C\']",w,n/d,1\n"[\'D\']",x,1991,2,EXTRA\n"[\'E\']",y\n'


def test_run_etl_counts_and_rejects(spark, text_file, scratch):
    base = scratch("etl")
    out = run_etl(spark, text_file(a=CATALOG), base + "/t.parquet", rejects_path=base + "/r.parquet")
    assert out == base + "/t.parquet"
    assert out.counts == {"read": 5, "kept": 2, "rejected": 3, "no_year": 1, "bad_year": 1, "out_of_range": 1, "corrupt": 1, "short": 1, "latin_1": 0, "utf_8": 0}
    assert sorted((r.artist, r.year, r.streams) for r in spark.read.parquet(out).collect()) == [("A", 1990, 5), ("D", 1991, 2)]
    left = sorted((r.artist, r.name, r.reject_reason, r.reject_record) for r in spark.read.parquet(base + "/r.parquet").collect())
    assert left == [("B", "u\nv", "out_of_range", None), ("C", "w", "bad_year", None), ("E", "y", "no_year", "\"['E']\",y")]
    raw = read_delimited(spark, text_file(a=CATALOG), info="told")
    assert rows_of(audit_etl(raw, "told")) == [("kept", "", 2, 1), ("rejected", "bad_year", 1, 0), ("rejected", "no_year", 1, 0), ("rejected", "out_of_range", 1, 0)]


@pytest.mark.parametrize(("data", "kept", "streams"), [(b"artist,year,popularity\nA,2100,5\nB,,3\nC,2101,1\n", 2, 6), (b"artist,year,popularity\nA,1990,0\nB,1991,x\n", 2, 2), (b"artist,year,popularity\nA,2100,0\nB,,0\n", 1, 1), (b"artist,year,popularity\n", 0, None)])
def test_run_etl_where_guards_fire(spark, text_file, scratch, data, kept, streams):
    path = text_file(a=data)
    out = run_etl(spark, path, scratch("etl") + "/t.parquet")
    lazy = normalize_tracks(read_delimited(spark, path))
    got = spark.read.parquet(out)
    assert rows_of(got) == rows_of(lazy) and out.counts["kept"] == kept
    assert got.agg(F.sum("streams")).first()[0] == streams


def test_readers_see_the_old_table_until_the_new_one_is_whole(spark, text_file, scratch, monkeypatch):
    target = scratch("etl") + "/t.parquet"
    run_etl(spark, text_file(a=b"artist,year,popularity\nOLD,1990,5\n"), target)
    seen, move = [], publish.move

    def watched(spark, source, to):
        seen.append([r.artist for r in spark.read.parquet(target).collect()])
        move(spark, source, to)

    monkeypatch.setattr(publish, "move", watched)
    run_etl(spark, text_file(a=b"artist,year,popularity\nNEW,2100,0\n"), target)  # both guards fire: written twice
    assert len(seen) >= 3 and all(s == ["OLD"] for s in seen)
    assert [r.artist for r in spark.read.parquet(target).collect()] == ["NEW"]


def test_failed_jobs_leave_the_table_as_it_was(spark, scratch):
    path = scratch("keep") + "/t.parquet"
    write_parquet_safe(spark.range(3), path)
    with pytest.raises(Exception, match="bad row"):
        write_parquet_safe(spark.range(3).select(F.raise_error(F.lit("bad row")).cast("string").alias("c")), path)
    assert spark.read.parquet(path).count() == 3
    folder = path.rpartition("/")[0]
    _, fs = publish._file_system(spark, folder)
    assert [s.getPath().getName() for s in fs.listStatus(publish._file_system(spark, folder)[0])] == ["t.parquet"]


def test_csv_where_parquet_refuses(spark, scratch):
    path = scratch("fallback") + "/t.parquet"
    write_parquet_safe(spark.range(1), path)  # an older table, which must not be read for the new one
    df = spark.range(2).select(F.concat(F.lit("n"), "id").alias("name"), F.expr("make_interval(0, 0, 0, cast(id as int))").alias("gap"), F.array("id").alias("ids"))
    assert write_parquet_safe(df, path) == csv_sibling(path)
    got = read_parquet_or_csv(spark, path, csv_sibling(path))
    assert rows_of(got) == [("n0", "0 seconds", "[0]"), ("n1", "1 days", "[1]")]


def test_unfinished_folders_are_no_tables(spark, scratch):
    path = scratch("half")
    spark.range(3).write.parquet(path)
    assert exists(spark, path)
    publish.remove(spark, path + "/_SUCCESS")
    assert not exists(spark, path)


def test_open_quotes_are_told_with_and_without_stepping_through(spark):
    """Lines whose quotes are all of closed fields are told at once; all others by their states."""
    from trendloom.sources import records

    pieces = ["", "a", '"b"', '"', '""', '"c', 'd"', '"e""f"', "5\" x", '"g,h"', '"i"j']
    for sep in (",", "\t"):
        lines = [sep.join(p) for p in itertools.product(pieces, repeat=3)]
        df = spark.createDataFrame([(x,) for x in lines], "value string").withColumn("open", records.spanning(F.col("value"), sep))
        assert {r.value: r.open for r in df.collect()} == {x: records._open(x, sep) for x in lines}


def test_states_go_over_parts_of_a_block(spark, scratch, monkeypatch):
    """Records that span the bounds of the parts whose states are composed are whole."""
    from trendloom.sources import records
    from trendloom.sources.readers import read_delimited

    path = scratch("parts") + "/a.csv"
    lines = ["id,note"]
    for i in range(60):
        lines.append(f'{i},"x{i}' + "\n" * (i % 7) + f'end, ""{i}"""')
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    want = {(str(i), f"x{i}" + "\n" * (i % 7) + f'end, "{i}"') for i in range(60)}
    for bits in (0, 1, 2, 16):
        monkeypatch.setattr(records, "PART_BITS", bits)
        assert {tuple(r) for r in read_delimited(spark, path).collect()} == want


def test_rejects_are_told_from_records_parsed_once(spark, scratch):
    """The filter for rejects stands above the parser and below the other columns."""
    import trendloom.sources.writers as writers
    from trendloom.plans.etl import run_etl

    path, base = scratch("once") + "/a.csv", scratch("once-out")
    spark.createDataFrame([("artists,name,release_date,popularity\nx,y,1999,1\nz,,n/d,2\n",)], "value string").coalesce(1).write.text(path)
    plans, write = [], writers.write_parquet_safe

    def told(df, *rest):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, *rest)

    writers.write_parquet_safe = told
    try:
        run_etl(spark, path, base + "/t.parquet", rejects_path=base + "/r.parquet")
    finally:
        writers.write_parquet_safe = write
    last = plans[-1]
    assert last.count("from_csv") == 1 and last.index("from_json") < last.index("Filter") < last.index("from_csv")
    assert [r.reject_reason for r in spark.read.parquet(base + "/r.parquet").collect()] == ["bad_year"]
