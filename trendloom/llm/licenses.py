"""License scan by diagonal voting.

Each license is a template: a sequence of words. All runs of k words of a text
are hashed as the text streams by; those that stand in some template (told by
the templates' own hashes, a set of fixed size) are joined by Spark to the
template positions that hold them. A join row votes for a diagonal, the position
in the text less that in the template: a place where the template stands whole
puts all its votes on one diagonal, a word put in or left out moves the rest to
the next. Votes are summed by diagonal, neighbouring diagonals of one template
are merged, and each span is verified on the words themselves.

Phrases are templates of runs of two words, and count where all their words
stand consecutively. Notices are templates of runs of three words, and count
where the longest common subsequence with the span holds at least ``SIMILAR`` of
the notice's words: with a fifth of its words changed, a notice still has some
three in a row. Spans of a notice may overlap.

Defined results: a null or empty text has no words and score 0; every row of the
input gives a row, so rows that repeat, or share an id with another text, are
scanned one by one; a null id stays null. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.llm.common import LOWER, UPPER, Tokenizer, distinct, hash_words, map_batches, mix64, shingle_hashes, stage

# The phrases of the contract and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Wording of public license notices, by label.
NOTICES = {
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions"
    ),
    "apache": (
        "you may not use this file except in compliance with the license you may obtain a copy of the license at "
        "http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software "
        "distributed under the license is distributed on an as is basis without warranties or conditions of any kind "
        "either express or implied"
    ),
    "gpl": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version 3 of the license or at your option "
        "any later version"
    ),
    "lgpl": (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
        "general public license as published by the free software foundation either version 2 1 of the license or at "
        "your option any later version"
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met redistributions of source code must retain the above copyright notice this list "
        "of conditions and the following disclaimer"
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "mpl": (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
        "distributed with this file you can obtain one at http mozilla org mpl 2 0"
    ),
    "unlicense": (
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish "
        "use compile sell or distribute this software either in source code form or as a compiled binary for any purpose "
        "commercial or non commercial and by any means"
    ),
    "cc-by": (
        "this work is licensed under the creative commons attribution 4 0 international license to view a copy of this "
        "license visit http creativecommons org licenses by 4 0"
    ),
}

PHRASE_RUN, NOTICE_RUN, SIMILAR = 2, 3, 0.8
#: Diagonals of one notice that lie so near are one span; a span's diagonals spread over a fifth of the notice at most.
NEAR, SPREAD = 8, 0.2
#: Words on both sides of a vote that are kept for verifying: more than any template is long.
MARGIN = 160
#: The bytes between words: all below U+0080 but digits and letters.
_BREAK = np.ones(256, bool)
_BREAK[128:] = False
_BREAK[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
_SPACED = np.arange(256, dtype=np.uint8)
_SPACED[_BREAK] = 32


class Template:
    def __init__(self, number: int, label: str, text: str, k: int, exact: bool):
        self.number, self.label, self.words, self.k, self.exact = number, label, text.split(), k, exact
        h = shingle_hashes(hash_words([w.encode() for w in self.words]), k)
        #: a run's hash tells its length too, as runs of two and of three words share one table
        self.runs = mix64(h + np.uint64(k))


def templates(phrases: dict[str, str] | None = None, notices: dict[str, str] | None = None) -> list[Template]:
    phrases, notices = PHRASES if phrases is None else phrases, NOTICES if notices is None else notices
    made = [(label, text, PHRASE_RUN, True) for text, label in phrases.items()] + [(label, text, NOTICE_RUN, False) for label, text in notices.items()]
    if short := [m[1] for m in made if len(m[1].split()) < m[2]]:
        raise ValueError(f"templates of fewer words than a run: {short}")
    return [Template(i, *m) for i, m in enumerate(made)]


def positions(spark: SparkSession, made: list[Template]) -> DataFrame:
    """(run, template, at): every run of words of every template; its size is that of the templates."""
    rows = [(int(h.astype(np.int64)), t.number, i) for t in made for i, h in enumerate(t.runs)]
    return spark.createDataFrame(rows, "run long, template int, at int")


def spaced(texts: pa.Array) -> pa.Array:
    """The texts with a space for each byte that is in no word."""
    texts = pa.concat_arrays([texts.fill_null("").cast(pa.large_string())])
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return texts
    return pa.Array.from_buffers(pa.large_string(), len(texts), [None, offsets, pa.py_buffer(_SPACED[np.frombuffer(data, np.uint8)].tobytes())], offset=texts.offset)


def votes(docs: DataFrame, made: list[Template], doc_id: str, text: str) -> DataFrame:
    """row, doc_id, n_words; ``hits``: places of runs that some template holds; ``parts``: the words around them."""
    known = {k: distinct(np.concatenate([t.runs for t in made if t.k == k])) for k in sorted({t.k for t in made})}
    schema = "row long, doc_id long, n_words long, hits array<struct<run:long,place:long>>, parts array<struct<first:long,words:array<string>>>"

    def make():
        tok = Tokenizer()

        def one(rows, ids, texts):
            bare = spaced(texts)
            n_words, hits, parts = np.zeros(len(bare), np.int64), [None] * len(bare), [None] * len(bare)
            for b in tok.blocks(bare):
                n_words[b.first : b.first + len(b.bounds) - 1] = np.diff(b.bounds)
                found = []
                for k, runs in known.items():
                    if len(b.hashes) < k:
                        continue
                    h = shingle_hashes(b.hashes, k)
                    h = mix64(h + np.uint64(k))
                    at = np.flatnonzero(runs[np.minimum(np.searchsorted(runs, h), len(runs) - 1)] == h)
                    doc = np.searchsorted(b.bounds, at, "right") - 1
                    whole = at + k <= b.bounds[doc + 1]  # not across two documents
                    found.append((doc[whole], at[whole], h[at[whole]]))
                if not any(len(f[0]) for f in found):
                    continue
                doc, at, run = (np.concatenate(x) for x in zip(*found, strict=True))
                for d in distinct(doc):
                    mine = doc == d
                    places = at[mine] - b.bounds[d]
                    i = int(b.first + d)
                    hits[i] = [{"run": int(r), "place": int(p)} for r, p in zip(run[mine].astype(np.int64), places, strict=True)]
                    parts[i] = list(around(bare[i].as_py(), np.sort(places)))
            return {"row": rows, "doc_id": ids, "n_words": n_words, "hits": hits, "parts": parts}

        return one

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(rows, schema, make)


def around(text: str, places: np.ndarray) -> Iterator[dict]:
    """The words of ``text`` within MARGIN of some place, as runs of words and where they begin."""
    words = text.translate(str.maketrans(UPPER, LOWER)).split(" ")
    words = [w for w in words if w]
    cuts = np.flatnonzero(np.diff(places) > 2 * MARGIN) + 1
    for some in np.split(places, cuts):
        first = max(0, int(some[0]) - MARGIN)
        yield {"first": first, "words": words[first : int(some[-1]) + MARGIN]}


def common_words(pattern: list[str], words: list[str]) -> int:
    """Length of the longest common subsequence, a bit for each word of ``pattern``."""
    masks: dict[str, int] = {}
    for i, w in enumerate(pattern):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(pattern)) - 1
    row = full
    for w in words:
        m = masks.get(w, 0)
        if m:
            both = row & m
            row = ((row + both) | (row - both)) & full
    return len(pattern) - row.bit_count()


def spans(voted: DataFrame, made: list[Template]) -> DataFrame:
    """row, template, first, last (words, both inside): merged diagonals, not verified yet."""
    spark = voted.sparkSession
    hits = voted.where("hits IS NOT NULL").select("row", F.explode("hits").alias("h")).select("row", "h.run", "h.place")
    joined = hits.join(F.broadcast(positions(spark, made)), "run")  # a row for each run of each template
    diagonals = joined.groupBy("row", "template", (F.col("place") - F.col("at")).alias("diagonal")).agg(
        F.count("*").alias("votes"), F.min("place").alias("first"), F.max("place").alias("last"))
    exact = [t.number for t in made if t.exact]
    length = F.create_map(*[F.lit(x) for t in made for x in (t.number, len(t.words))])
    k = F.create_map(*[F.lit(x) for t in made for x in (t.number, t.k)])
    # a phrase has all its votes on one diagonal, and spans it
    phrases = diagonals.where(F.col("template").isin(exact) & (F.col("votes") == length[F.col("template")] - k[F.col("template")] + 1))
    phrases = phrases.select("row", "template", F.col("diagonal").alias("first"), (F.col("diagonal") + length[F.col("template")] - 1).alias("last"))
    # neighbouring diagonals of a notice: a new span where the gap, or the spread from a multiple of it, is too wide
    by = "PARTITION BY row, template ORDER BY diagonal"
    notices = diagonals.where(~F.col("template").isin(exact)).withColumn("length", length[F.col("template")])
    notices = notices.withColumn("new", F.expr(f"CASE WHEN diagonal - lag(diagonal) OVER ({by}) <= {NEAR} THEN 0 ELSE 1 END"))
    notices = notices.withColumn("run", F.expr(f"sum(new) OVER ({by})"))
    notices = notices.withColumn("base", F.expr("min(diagonal) OVER (PARTITION BY row, template, run)"))
    wide = F.floor((F.col("diagonal") - F.col("base")) / F.greatest(F.lit(1), F.floor(F.col("length") * SPREAD)))
    # cells of the spread overlap by one, so that a place on the border of two is whole in one of them
    notices = notices.withColumn("cell", F.explode(F.array(wide, wide + 1)))
    notices = notices.groupBy("row", "template", "run", "cell").agg(
        F.sum("votes").alias("votes"), F.min("first").alias("first"), (F.max("last") + NOTICE_RUN - 1).alias("last"), F.min("diagonal").alias("low"), F.max(F.col("diagonal") + F.col("length")).alias("high"))
    # the words before the first and after the last vote count too, as far as the template reaches
    notices = notices.select("row", "template", F.greatest(F.lit(0), F.least("first", "low")).alias("first"), F.greatest("last", F.col("high") - 1).alias("last"))
    return phrases.unionByName(notices.select("row", "template", F.col("first").cast("long"), F.col("last").cast("long")))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", phrases: dict[str, str] | None = None, notices: dict[str, str] | None = None, similar: float = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """(rows, found): row, doc_id, n_words of every input row; and its verified spans: row, label, exact, first, last, score."""
    made = templates(phrases, notices)
    voted = stage(votes(docs, made, doc_id, text), "license-votes")
    wanted = spans(voted, made).groupBy("row").agg(F.collect_list(F.struct("template", "first", "last")).alias("spans"))
    joined = voted.where("hits IS NOT NULL").select("row", "parts").join(wanted, "row")

    def make():
        def one(rows, parts, wanted):
            out = {c: [] for c in ("row", "label", "exact", "first", "last", "score")}
            for row, held, some in zip(rows.to_pylist(), parts.to_pylist(), wanted.to_pylist(), strict=True):
                for s in some:
                    t = made[s["template"]]
                    part = next((p for p in reversed(held) if p["first"] <= s["first"]), held[0])
                    words = part["words"][max(0, s["first"] - part["first"]) : s["last"] + 1 - part["first"]]
                    score = float(words == t.words) if t.exact else common_words(t.words, words) / len(t.words)
                    if score >= (1.0 if t.exact else similar):
                        for c, v in zip(out, (row, t.label, t.exact, s["first"], s["last"], score), strict=True):
                            out[c].append(v)
            return out

        return one

    found = map_batches(joined.select("row", "parts", "spans"), "row long, label string, exact boolean, first long, last long, score double", make)
    return voted.select("row", "doc_id", "n_words"), found


def scan_licenses(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (the best span's share of its template)."""
    rows, found = scan(docs, **options)
    base = F.when(F.col("exact"), F.col("first"))
    sums = found.groupBy("row").agg(
        F.count(base).alias("n_base"), F.min(base).alias("first_word"), F.max(base).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("exact"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("score").alias("score"))
    return rows.join(sums, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
