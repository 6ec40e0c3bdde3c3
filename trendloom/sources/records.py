"""Delimited text as records: lines, or runs of lines where a quoted field holds a break.

A line acts on the state "inside a quoted field": given the state before it, it
fixes the state after it. These actions compose, so the state at every line comes
from running composition inside each part of a block of a file and then over the
file's parts, and no file or block has to go through one task. All of it is built-in
expressions; files without a break inside quotes skip it.
"""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A record of more lines than this comes of a stray quote: its lines are records of their own.
MAX_RECORD_LINES = 10_000
#: Files with breaks in quotes that are named one by one; beyond it all files are regrouped.
MAX_NAMED_FILES = 1000
#: Lines of a task whose states are composed together, as a power of two.
PART_BITS = 16
#: Lines that a header may span.
HEAD_LINES = 64
LATIN_1 = "ISO-8859-1"
UTF_8 = "UTF-8"
_CHARSETS = {"utf-8": UTF_8, "utf8": UTF_8, "latin-1": LATIN_1, "latin1": LATIN_1, "iso-8859-1": LATIN_1}

# States within a line: in an unquoted field, at a field's begin, inside quotes, at a quote inside quotes.
_FIELD, _BEGIN, _INSIDE, _QUOTE = range(4)


@dataclass(frozen=True)
class Dialect:
    sep: str
    header: str  # as it stands in the file
    names: tuple[str, ...]


def charset(encoding: str | None) -> str | None:
    if encoding is None:
        return None
    if encoding.lower() not in _CHARSETS:
        raise ValueError(f"encoding {encoding!r} is none of {sorted(_CHARSETS)}")
    return _CHARSETS[encoding.lower()]


def header_names(header: str, sep: str) -> tuple[str, ...]:
    """Field names of a header; empty ones are numbered, repeated ones too (case counts)."""
    out: list[str] = []
    for i, name in enumerate(next(csv.reader(header.splitlines(True), delimiter=sep, quotechar='"'), [])):
        name = name or f"Unnamed: {i}"
        n = 0
        while (f"{name}.{n}" if n else name) in out:
            n += 1
        out.append(f"{name}.{n}" if n else name)
    return tuple(out)


def open_after(line: Column, sep: str, inside: bool) -> Column:
    """Whether a quoted field is open at the end of a line, given whether one is at its begin.

    As CSV parsers do, a quote opens a field only at the field's begin, two
    quotes inside are one, and what follows a closing quote is plain text.
    """
    parts = F.split(line, '"', -1)
    first = F.element_at(parts, 1)
    begin = F.lit(_INSIDE) if inside else F.when((first == "") | first.endswith(F.lit(sep)), _BEGIN).otherwise(_FIELD)

    def step(state: Column, part: Column) -> Column:
        at = F.when(state == _BEGIN, _INSIDE).when(state == _INSIDE, _QUOTE).when(state == _QUOTE, _INSIDE).otherwise(_FIELD)
        return F.when(part == "", at).when(at == _INSIDE, _INSIDE).when(part.endswith(F.lit(sep)), _BEGIN).otherwise(_FIELD)

    state = F.aggregate(F.slice(parts, 2, F.size(parts)), begin, step)
    if inside:
        return F.when(line.contains('"'), state == _INSIDE).otherwise(F.lit(True))
    # where all quotes are those of quoted fields that end on the line, none is open: no need to step through it
    left = F.regexp_replace(F.concat(F.lit(sep), line), f'{re.escape(sep)}"[^"]*+"(?={re.escape(sep)}|\\z)', sep)
    return F.when(line.contains('"'), F.when(left.contains('"'), state == _INSIDE).otherwise(F.lit(False))).otherwise(F.lit(False))


def spanning(lines: Column, sep: str) -> Column:
    """Whether a line that begins a record leaves a quoted field open."""
    return open_after(lines, sep, False)


def spellings(files: list[str]) -> list[str]:
    """Paths as a file listing and as a row's metadata may spell them."""
    out = []
    for f in files:
        scheme, _, rest = f.partition(":")
        forms = [f, f"{scheme}:/{rest.lstrip('/')}", f"{scheme}:///{rest.lstrip('/')}"] if rest.startswith(("///", "/")) and not re.match("//[^/]", rest) else [f]
        out.extend(dict.fromkeys(y for x in forms for y in (x, quote(x, safe="/:%"), unquote(x))))
    return out


def _lines(spark: SparkSession, path: str, whole_breaks: bool) -> DataFrame:
    reader = spark.read.option("lineSep", "\n") if whole_breaks else spark.read
    return reader.format("text").load(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def read_dialect(spark: SparkSession, path: str, separators: tuple[str, ...]) -> Dialect:
    """From the begin of the first file (by path): the header record, and the first separator that splits it."""
    files = sorted(spark.read.format("text").load(path).inputFiles())
    for file in files:  # files without a line are passed over
        head = _lines(spark, path, False).where(F.col("file").isin(spellings([file])))
        first = head.orderBy("block", F.monotonically_increasing_id()).select("value").first()
        if first is not None:
            break
    else:
        raise ValueError(f"empty input: {path}")
    for sep in separators:
        header = first[0]
        if len(header_names(header, sep)) < 2 and '"' not in header:
            continue
        if _open(header, sep):
            whole = _lines(spark, path, True).where(F.col("file").isin(spellings([file])))
            lines = [r[0] for r in whole.orderBy("block", F.monotonically_increasing_id()).select("value").limit(HEAD_LINES).collect()]
            n = 1
            while n < len(lines) and _open("\n".join(lines[:n]), sep):
                n += 1
            header = "\n".join(lines[:n]).removesuffix("\r")
        names = header_names(header, sep)
        if len(names) >= 2:
            return Dialect(sep, header, names)
    raise ValueError(f"could not split the header with any of {separators!r}: {first[0][:80]!r}")


def _open(text: str, sep: str) -> bool:
    """``open_after`` for the header, on the driver."""
    state = _BEGIN
    for c in text:
        if c == '"':
            state = {_BEGIN: _INSIDE, _INSIDE: _QUOTE, _QUOTE: _INSIDE}.get(state, state)
        elif state != _INSIDE:
            state = _BEGIN if c == sep else _FIELD
    return state == _INSIDE


def _running(kind: str, window, flip: str, constant: str) -> dict[str, Column]:
    """Composition of all actions of a window: flips, and what the last constant action gave."""
    return {f"{kind}_flips": F.coalesce(F.sum(flip).over(window), F.lit(0)), f"{kind}_last": F.last(constant, ignorenulls=True).over(window)}


def _state(kind: str, before: Column) -> Column:
    """The state after the composed actions, from the state before them."""
    flips, last = F.col(f"{kind}_flips"), F.col(f"{kind}_last")
    return F.when(last.isNull(), (before + flips) % 2).otherwise((last["state"] + flips - last["flips"]) % 2).cast("int")


def _actions(df: DataFrame, after0: Column, after1: Column, by: list[str], order: list[str]) -> DataFrame:
    """Adds the running compositions before and up to each row."""
    upto = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumns({"after0": after0.cast("int"), "after1": after1.cast("int")})
    df = df.withColumn("flip", ((F.col("after0") == 1) & (F.col("after1") == 0)).cast("int"))
    df = df.withColumn("here", F.sum("flip").over(upto))
    df = df.withColumn("constant", F.when(F.col("after0") == F.col("after1"), F.struct(F.col("after0").alias("state"), F.col("here").alias("flips"))))
    return df.withColumns({**_running("before", before, "flip", "constant"), **_running("upto", upto, "flip", "constant")})


def regrouped(lines: DataFrame, sep: str) -> DataFrame:
    """Records (value, file, block, n; in order of the last three) of lines (value, file, block) that are split at line feeds only."""
    value = F.col("value")
    # a task's lines in parts of bounded size, so that no window holds a whole block
    part = ["file", "block", "part"]
    lines = lines.withColumn("n", F.monotonically_increasing_id()).withColumn("part", F.shiftright("n", PART_BITS))
    lines = _actions(lines, open_after(value, sep, False), open_after(value, sep, True), part, ["n"])
    upto = Window.partitionBy(*part).orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begins = {f"begins{s}": (_state("before", F.lit(s)) == 0).cast("int") for s in (0, 1)}
    ends = {f"ends{s}": _state("upto", F.lit(s)) for s in (0, 1)}
    lines = lines.select(*part, "n", "value", *[c.alias(k) for k, c in {**begins, **ends}.items()])
    lines = lines.withColumns({f"record{s}": F.sum(f"begins{s}").over(upto) for s in (0, 1)})
    # one row for each part of a block of a file
    blocks = lines.groupBy(*part).agg(*[F.max_by(f"ends{s}", "n").alias(f"ends{s}") for s in (0, 1)], *[F.sum(f"begins{s}").alias(f"count{s}") for s in (0, 1)])
    blocks = _actions(blocks, F.col("ends0"), F.col("ends1"), ["file"], ["block", "part"]).withColumn("inside", _state("before", F.lit(0)))
    held = F.when(F.col("inside") == 0, F.col("count0")).otherwise(F.col("count1"))
    earlier = Window.partitionBy("file").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("held", held).select(*part, "inside", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("base"))
    lines = lines.join(blocks, part).select("file", "block", "n", "value", (F.col("base") + F.when(F.col("inside") == 0, F.col("record0")).otherwise(F.col("record1"))).alias("record"))
    stray = lines.groupBy("file", "record").agg(F.count("*").alias("size")).where(F.col("size") > MAX_RECORD_LINES).select("file", "record", F.lit(True).alias("stray"))
    lines = lines.join(stray, ["file", "record"], "left").withColumn("alone", F.when(F.col("stray"), F.col("n")))
    whole = lines.groupBy("file", "record", "alone").agg(F.array_sort(F.collect_list(F.struct("block", "n", "value"))).alias("some"))
    text = F.array_join(F.transform("some", lambda x: x["value"]), "\n")
    return whole.select(F.regexp_replace(text, "\r$", "").alias("value"), "file", F.element_at("some", 1)["block"].alias("block"), F.element_at("some", 1)["n"].alias("n"))


def read_records(spark: SparkSession, path: str, dialect: Dialect, spans: bool | None = None) -> DataFrame:
    """``value``: every record but headers and blank lines, as raw bytes held in text.

    ``spans`` says whether records may span lines; None finds out by one pass
    that reads the lines only, and regroups those files in which they do.
    """
    return ordered_records(spark, path, dialect, None, spans).select("value")


def ordered_records(spark: SparkSession, path: str, dialect: Dialect, files: list[str] | None, spans: bool | None = None) -> DataFrame:
    """``read_records`` with file, block, n: the order of records; of these files only, if given."""

    def lines(whole_breaks: bool) -> DataFrame:
        found = _lines(spark, path, whole_breaks)
        return found if files is None else found.where(F.col("file").isin(files))

    plain = lines(False).withColumn("n", F.monotonically_increasing_id())
    if spans is None:
        some = lines(False).where(spanning(F.col("value"), dialect.sep)).select("file").distinct().limit(MAX_NAMED_FILES + 1)
        names = [r.file for r in some.collect()]
        spans = len(names) > MAX_NAMED_FILES
        if names and not spans:
            file = F.col("file")
            return _data(plain.where(~file.isin(names)).unionByName(regrouped(lines(True).where(file.isin(names)), dialect.sep)), dialect)
    return _data(regrouped(lines(True), dialect.sep) if spans else plain, dialect)


def _data(records: DataFrame, dialect: Dialect) -> DataFrame:
    space = " \r" if dialect.sep == "\t" else " \t\r"
    return records.where((F.col("value") != F.lit(dialect.header)) & (F.translate("value", space, "") != ""))


def decoded(value: Column, encoding: str | None) -> Column:
    """Raw bytes as text. Without a named encoding, bytes that are no UTF-8 are taken as Latin-1, record by record."""
    latin = F.decode(value.cast("binary"), LATIN_1)
    return latin if encoding == LATIN_1 else value if encoding == UTF_8 else F.when(F.is_valid_utf8(value), value).otherwise(latin)


#: What ``parsed`` tells of a record beside its fields.
INFO = "ragged string, record string, latin_1 boolean, wide boolean"


def parsed(records: DataFrame, dialect: Dialect, encoding: str | None, info: str) -> DataFrame:
    """Fields c0, c1, ... as text, and the struct ``info``: ragged (``long`` or ``short``: more or fewer
    fields than the header), record (the raw text of a ragged one), latin_1 (its bytes were no UTF-8),
    wide (it is UTF-8 and not ASCII)."""
    n = len(dialect.names)
    schema = ", ".join([*[f"c{i} string" for i in range(n)], "bad string"])
    options = {"sep": dialect.sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad", "multiLine": "true"}
    text = records.select(decoded(F.col("value"), encoding).alias("text"), F.is_valid_utf8("value").alias("utf_8"), (F.octet_length("value") > F.char_length("value")).alias("wide"))
    rows = text.select(F.from_csv("text", schema, options).alias("f"), "utf_8", "wide")
    bare = F.regexp_replace(F.col("f.bad"), '"[^"]*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(dialect.sep), F.lit(""))) + 1
    ragged = F.when(F.col("f.bad").isNotNull(), F.when(fields > n, "long").otherwise("short"))
    return rows.select(*[F.col(f"f.c{i}").alias(f"c{i}") for i in range(n)], F.struct(ragged.alias("ragged"), F.col("f.bad").alias("record"), (~F.col("utf_8")).alias("latin_1"), (F.col("utf_8") & F.col("wide")).alias("wide")).alias(info))
