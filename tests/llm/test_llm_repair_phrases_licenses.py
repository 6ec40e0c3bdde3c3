"""Conversation repair, phrase collocations and license scans against plain versions and SQL."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import product

import duckdb
import numpy as np
import pandas as pd
import pytest

from trendloom.llm import conversations, licenses, phrases
from trendloom.llm.common import BitTable, table

SF = "/root/testdata/sf0.001"
TALKS = "conv_id long, turn long, role string, text string, key string, n long, part int, block string, kind string, fault int"
DOCS = "doc_id long, text string, lang string, row string, n long, phrase string, score string, template int"


def sql_rows(query: str, name: str, frame: pd.DataFrame) -> list[tuple]:
    con = duckdb.connect()
    con.register("given_frame", frame)
    con.execute(f"CREATE VIEW {name} AS SELECT * FROM given_frame")
    rel = con.sql(query)
    cols = sorted(rel.columns)
    at = [rel.columns.index(c) for c in cols]
    return sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr)


def spark_rows(df) -> list[tuple]:
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


# ---- conversation repair


def talks(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2, "b", "x", 0) for r in rows], TALKS)


def odd_talks():
    rng = random.Random(5)
    roles = ["user", "assistant", "system", "tool", "", " ", None, "User", "su"]
    texts = ["Fine.", "cut off", "", " \t\n", None, "why?", "no!", "same.", "same.", "é…", "a" * 5000, "x. y"]
    rows = []
    for conv in [None, -3, *range(40)]:
        turn = 0
        for _ in range(rng.randrange(0, 14)):
            turn += rng.choice([0, 1, 1, 1, 2])
            rows.append((conv, rng.choice([turn, turn, turn, None]), rng.choice(roles), rng.choice(texts)))
    rows += [(90, t, "user" if t % 2 else "system", "a b c") for t in range(60)]  # all truncated
    rows += [(91, 5, "assistant", "Yes.")] * 6 + [(91, 5, "user", "Yes.")] * 2
    rows += [(92, None, None, None)]
    return rows


def plain_repair(rows):
    """Each conversation by a plain dynamic program over whole audit strings."""
    sort = lambda t: (t is not None, t or 0)
    out = {}
    for conv in {r[0] for r in rows}:
        mine = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if kind:
                text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
                mine += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        mine.sort(key=lambda r: (sort(r[0]), r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in mine:
            bare = re.sub("[\x20\x09-\x0d]", "", text)
            faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        step = {"": "u", "s": "u", "u": "a", "a": "u"}
        full = {"u": "user", "a": "assistant"}

        def grown(states, step=step, full=full):
            for s in ("", "s", "a", "u", "a"):
                if s in states:
                    c, a, lines = states[s]
                    new = (c + 5, a + "I", (*lines, full[step[s]] + ":"))
                    states[step[s]] = min(states.get(step[s], new), new)
            return states

        states = grown({"": (0, "", ())})
        for (_, role, text), fault in zip(mine, faults, strict=True):
            new: dict = {}
            for s, (c, a, lines) in states.items():
                ways = [(s, c + 2, a + "D", lines)]
                if fault not in ("b", "d"):
                    more = 5 if fault == "t" else 0
                    ways.append((step[s], c + 1 + more, a + "R", (*lines, f"{full[step[s]]}:{text}")))
                    if role[:1] == step[s] or role[:1] == "s" and s == "":
                        ways.append((role[:1], c + more, a + "K", (*lines, f"{role}:{text}")))
                for to, *way in ways:
                    new[to] = min(new.get(to, tuple(way)), tuple(way))
            states = grown(new)
        cost, audit, lines = min(states[s] for s in ("", "a") if s in states)
        turns = {r[0] for r in mine if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in zip(mine, mine[1:], strict=False))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest)
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize(("block_rows", "parts"), [(1024, 8), (3, 40)])
def test_repair_equals_plain(spark, block_rows, parts):
    rows = odd_talks()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = conversations.repair_damaged(talks(spark, rows), block_rows).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got} == plain_repair(rows)
    assert len(got) == len({r[0] for r in rows})


def test_repair_equals_sql(spark):
    rows = [r for r in odd_talks() if r[2] != "é"]
    frame = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
    assert spark_rows(conversations.repair_damaged(talks(spark, rows))) == sql_rows(conversations.ORACLE, "conversations", frame)


def test_one_conversation_over_many_parts(spark):
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["Done.", f"row {t}.", f"cut {t}"])) for t in range(1500)]
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert conversations.blocks(conversations.damage(talks(spark, rows)), 64).select("part").distinct().count() > 1
        (got,) = conversations.repair_damaged(talks(spark, rows), 64).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert tuple(got[c] for c in COLUMNS) == plain_repair(rows)[1]


def test_repaired_rows_follow_the_pattern(spark):
    found, repaired = conversations.repair(talks(spark, odd_talks()), 4)
    lines: dict = {}
    for r in repaired.orderBy("part", "block", "line").collect():
        lines.setdefault(r.conv_id, []).append(r.role[:1])
    assert all(re.fullmatch("(s?(ua)+)?", "".join(v)) for v in lines.values())
    assert {r.conv_id for r in found.collect()} >= set(lines)


def test_empty_conversations(spark):
    assert conversations.repair_damaged(talks(spark, [])).collect() == []
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    (row,) = conversations.repair_damaged(talks(spark, [(dropped, 0, "user", "Hi.")])).collect()
    assert tuple(row[c] for c in COLUMNS) == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


@pytest.mark.parametrize("mod", [conversations.MOD, 7, 1])
def test_trails_order_even_if_hashes_collide(monkeypatch, mod):
    monkeypatch.setattr(conversations, "MOD", mod)
    trails, nodes = conversations.Trails(), {"": 0}
    for size in range(1, 5):
        for s in map("".join, product("DKR", repeat=size)):
            nodes[s] = trails.add(nodes[s[:-1]], s[-1])
    names = random.Random(2).sample(sorted(nodes), 60)
    for x, y in product(names, names):
        assert trails.less(nodes[x], nodes[y]) == (x < y)
    assert all(trails.spell(n) == s for s, n in nodes.items())


# ---- phrase collocations


def texts(spark, rows):
    return spark.createDataFrame([(i, t, g, "r", 1, "p", "s", 0) for i, t, g in rows], DOCS)


def odd_texts(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text", "lang").collect()]
    rng = random.Random(11)
    words = ["new", "york", "city", "hall", "é", " x", "of", "the"]
    for n in range(300):
        rows.append((5000 + n, " ".join(rng.choice(words) for _ in range(rng.randrange(40))), rng.choice(["en", None, "und", "", "xx"])))
    rows += [(6000, None, "en"), (6001, "", None), (6002, " .,;\n\t ", "xx"), (None, "New  York\tcity HALL. " * 40, "xx"), (6003, "a a a a a a a a " * 30, "xx"), (6004, "one,two;three:four!five?six\nseven\x0beight\x0cnine\rten", "en")]
    rows += [(6005, "deep in the far north " * 35, "en")] * 2 + [(6006, "x" * 50000 + " y", "en")]
    return rows


def test_collocations_equal_sql(spark):
    rows = odd_texts(spark)
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "lang"]).astype({"doc_id": "Int64"})
    want = sql_rows(phrases.ORACLE, "documents", frame)
    assert len(want) > 100
    assert spark_rows(phrases.collocations(texts(spark, rows).repartition(3))) == want


def test_collocations_by_small_units_and_many_ranges(spark, monkeypatch):
    rows = odd_texts(spark)
    whole = spark_rows(phrases.collocations(texts(spark, rows)))
    monkeypatch.setattr(phrases, "RANGE_PLACES", 500)
    assert spark_rows(phrases.collocations(texts(spark, rows).repartition(16))) == whole


def test_collocations_through_a_full_table(spark, monkeypatch):
    rows = odd_texts(spark)
    whole = spark_rows(phrases.collocations(texts(spark, rows)))
    monkeypatch.setattr(phrases.BitTable, "of", lambda hashes, n: BitTable(np.full(64, 255, np.uint8)))
    assert spark_rows(phrases.collocations(texts(spark, rows))) == whole


def test_no_texts(spark):
    assert phrases.collocations(texts(spark, [])).collect() == []
    assert phrases.collocations(texts(spark, [(1, None, "en"), (2, "few words", None)])).collect() == []


def test_transducers():
    rng = random.Random(4)
    paths = lambda n: [tuple(rng.choice("abcd") for _ in range(rng.randrange(1, 5))) for _ in range(n)]
    counts = lambda some: {p: some.count(p) for p in sorted(set(some))}

    def built(some):
        t = phrases.Transducer()
        for p, n in counts(some).items():
            t.add(p, n)
        return t.finish()

    x, y = paths(200), paths(300)
    a, b = built(x), built(y)
    assert dict(a.paths()) == counts(x) and list(a.paths()) == sorted(a.paths())
    assert dict(phrases.Transducer.load(a.dump()).paths()) == counts(x)
    both = phrases.Transducer.union([a, b, built([])])
    assert dict(both.paths()) == counts(x + y)
    wanted = sorted({*paths(80), ("a", "x"), ("x",), ("a", "b", "c", "d", "a")})
    assert dict(both.compose(wanted)) == {p: (x + y).count(p) for p in wanted}
    # equal ends are one state
    t = phrases.Transducer()
    for first in "abcdefgh":
        t.add((first, "x", "y"), 3)
    assert len({id(s) for _, s in t.finish().root[1]}) == 1


def test_scores_past_64_bits(spark):
    big = 9_000_000_000_000_000_000
    found = spark.createDataFrame([("en", "a b", big), ("en", "c d", 31)], "lang string, phrase string, n long")
    parts = spark.createDataFrame([("en", "a", big), ("en", "b", big), ("en", "c", 31), ("en", "d", 62)], "lang string, part string, n long")
    assert {r.phrase: r.score for r in phrases.score(found, parts).collect()} == {"a b": 1_000_000, "c d": 2_000_000 * 31 // 93}


# ---- license scan

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_base(text):
    words = WORD.findall((text or "").translate(str.maketrans(licenses.UPPER, licenses.LOWER)))
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        hits = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += hits
        labels |= {label} if hits else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def edited(words, share, rng):
    """``words`` with that share replaced, one in each stretch."""
    out, step = list(words), round(1 / share)
    for i in range(rng.randrange(step), len(out), step):
        out[i] = f"w{rng.randrange(10**6)}"
    return out


def test_license_scan(spark):
    rng = random.Random(6)
    filler = [f"word{i}" for i in range(500)]
    fill = lambda n: [rng.choice(filler) for _ in range(n)]
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text", "lang").collect()]
    odd = [None, "", " ", "mit", "MIT-License!", "cc by cc by cc by", "mit license " * 3000, "theémit license", "mit licenses", "gnu general public", "GNU_General\nPublic--License", "mit\x00license",
           " ".join(fill(20000) + ["apache", "license"] + fill(20000) + ["cc", "BY"]), "gnu gnu general public license general public license", "mit apache license by cc"]
    rows += [(2000 + i, t, None) for i, t in enumerate(odd)] + [(2000, "mit license", "en"), (2004, "MIT-License!", None), (None, "cc by", None)]
    planted = {}
    for i, (label, notice) in enumerate([*licenses.NOTICES.items()] * 4):
        share = (0.0, 0.1, 0.15, 0.17)[i // len(licenses.NOTICES)]
        words = notice.split()
        words = edited(words, share, rng) if share else words
        if i % 2 and share < 0.15:  # words put in
            at = rng.randrange(10, len(words))
            words = [*words[:at], "and", "so", *words[at:]]
        planted[3000 + i] = label
        rows.append((3000 + i, " ".join(fill(rng.randrange(400)) + words + fill(50)).title(), "en"))
    far = [w for w in licenses.NOTICES["bsd"].split()]
    rng.shuffle(far)
    rows.append((4000, " ".join(far), "en"))
    rows.append((4001, " ".join(licenses.NOTICES["isc"].split()[:20]), "en"))
    got = licenses.scan_licenses(texts(spark, rows)).collect()
    base = lambda r: (r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
    assert sorted(map(base, got), key=repr) == sorted(((i, *plain_base(t)) for i, t, _ in rows), key=repr)
    labels = {r.doc_id: r for r in got}
    assert all(label in labels[i].labels.split(",") and labels[i].score >= 0.8 for i, label in planted.items())
    assert all("" == labels[i].labels and labels[i].score == 0 for i in (4000, 4001))
    assert all(set(r.base_labels.split(",")) <= {"", *r.labels.split(",")} and 0 <= r.score <= 1 for r in got)
    assert all(r.labels == r.base_labels for r in got if r.doc_id is not None and r.doc_id < 2000)


def test_license_spans_are_those_of_the_words(spark):
    notice = licenses.NOTICES["mpl"].split()
    words = ["x"] * 300 + notice + ["y"] * 700 + notice[:10] + ["z"] + notice[10:]
    _, found = licenses.scan(texts(spark, [(1, " ".join(words), None)]))
    spans = [(r.first, r.last) for r in found.where("label = 'mpl'").collect()]
    for first in (300, 300 + len(notice) + 700):
        assert any(abs(f - first) <= 2 and last >= first + len(notice) - 1 for f, last in spans)


def test_license_options_and_empty(spark):
    assert licenses.scan_licenses(texts(spark, [])).collect() == []
    got = licenses.scan_licenses(texts(spark, [(1, "All Rights Reserved", None)]), phrases={"all rights reserved": "none"}, notices={}).collect()
    assert [(r.n_base, r.labels, r.score) for r in got] == [(1, "none", 1.0)]
    with pytest.raises(ValueError, match="fewer words"):
        licenses.templates(phrases={"one": "x"})


@pytest.mark.parametrize("seed", range(3))
def test_common_words_is_the_longest_common_subsequence(seed):
    rng = random.Random(seed)
    a, b = ([rng.choice("abcde") for _ in range(rng.randrange(60))] for _ in range(2))
    row = [0] * (len(b) + 1)
    for x in a:
        held = 0
        for j, y in enumerate(b):
            held, row[j + 1] = row[j + 1], held + 1 if x == y else max(row[j + 1], row[j])
    assert licenses.common_words(a, b) == row[-1]
