"""What the operators make of large groups of like rows grows with the rows, not with their pairs."""

import random

import numpy as np

from trendloom.llm import common, lines, pii

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def test_near_copies_of_a_line_are_not_paired(spark, monkeypatch):
    rng, made, stage = random.Random(5), {}, lines.stage

    def counted(df, name):
        out = stage(df, name)
        made[name] = out.count()
        return out

    monkeypatch.setattr(lines, "stage", counted)
    base = [f"word{i}" for i in range(24)]
    rows = [(i, " ".join([*base[:j], f"own{i}", *base[j + 1 :]]), "en", "s", 1) for i, j in ((i, rng.randrange(24)) for i in range(600))]
    got = lines.dedup_lines(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted(r.doc_id for r in got if r.n_removed == 0) == [0]
    assert max(made.values()) <= 25 * len(rows)  # there are 179,700 pairs


def test_only_known_patterns_are_counted(spark, monkeypatch):
    """Personal data: patterns of the texts that aren't known ones make no rows."""
    rng, made = random.Random(6), {}
    stage, map_batches = pii.stage, pii.map_batches

    def staged(df, name):
        made[name] = stage(df, name)
        return made[name]

    def mapped(df, schema, make, rows=None):
        out = map_batches(df, schema, make, rows)
        if schema == "pattern long, n long":
            made["counted"] = out
        return out

    monkeypatch.setattr(pii, "stage", staged)
    monkeypatch.setattr(pii, "map_batches", mapped)
    word = lambda: "".join(rng.choices("abcdefghij", k=4))
    words = lambda n: " ".join(word() for _ in range(n))
    before = [f"to{word()}" for _ in range(40)]
    text = lambda i: f"{words(200)} {before[i % 40]} a{i}@b.org {words(200)}"
    rows = [(i, text(i), "en", "s", 1) for i in range(400)]
    pii.find_pii(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    known = {r.pattern for r in made["pii-known"].collect()}
    counted = [r.pattern for r in made["counted"].collect()]
    assert len(known) >= 30 and set(counted) == known
    assert len(counted) <= 3 * len(known)


def test_counts_of_hashes_make_a_row_for_each_part(spark):
    """Line dedup, near duplicates: a task's counts are rows of many buckets, and their sums are exact."""
    hashes = np.random.default_rng(7).zipf(1.3, 100_000) % (1 << 40)
    docs = spark.createDataFrame([(int(h),) for h in hashes], "h long").repartition(3)
    count = lambda batches: common.count_hashes(batches, lambda b: [b.column(0).to_numpy().view(np.uint64)], 14)
    rows = docs.mapInArrow(count, "part int, at binary, n binary")
    assert rows.count() <= 3 * 4
    n = np.bincount(hashes & ((1 << 14) - 1), minlength=1 << 14).tolist()
    assert common.rarity_table(rows, 14).tolist() == [c.bit_length() for c in n]
