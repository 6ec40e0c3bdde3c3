"""Identifiers that only their contexts tell, against plants and a plain graph."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import pytest

import brute
from trendloom.llm import pii

SCHEMA = "doc_id long, text string, row string, kind int, value string, added int"
CUES = {
    "email": ["please write to {} for details", "you may reach us under {} any time", "mail your form to {} today"],
    "phone": ["please ring me at {} after noon", "our hotline {} is free", "fax number {} remains"],
    "ip": ["the server at {} responds slowly", "traffic from host {} was blocked"],
    "card": ["we charged the card {} yesterday", "paid with {} in full"],
}
UNSEEN = {
    "email": ["bob(at)corp.example", "jane[at]mail", "info#corp", "x_y_z@intranet", "sales at corp", "ÄÖ@firma"],
    "phone": ["0049-30-123456", "555.123.4567", "(030) 1234 567", "1-800-FLOWERS", "ext. 4711", "٣٤٥-٦٧٨٩"],
    "ip": ["fe80::1ff:fe23", "10.0.0.x", "300.1.2.3", "node-17.local"],
    "card": ["4111-XXXX-XXXX-1111", "**** **** 1234", "AMEX/3782"],
}


def seed_of(kind, n):
    return {"email": f"user{n}@host{n}.example.com", "phone": f"+1 (234) 555-{1000 + n}", "ip": f"10.1.{n % 250}.7", "card": luhn_card(n)}[kind]


def luhn_card(n):
    digits = f"4{n:014d}"
    return next(digits + str(c) for c in range(10) if brute.luhn(digits + str(c)))


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(4)
    words = [f"{a}{b}" for a in ("lo", "mi", "ta", "re", "su", "the", "at", "to") for b in ("", "n", "ra", "ko", "del")]
    fill = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs, plants = [], []
    for n in range(40):
        for kind, cues in CUES.items():
            for cue in cues:
                docs.append(f"{fill(rng.randrange(1, 20))} {cue.format(seed_of(kind, n * 7 + len(docs) % 5))} {fill(6)}")
    for kind, values in UNSEEN.items():
        for value in values:
            for cue in CUES[kind]:
                before = f"{fill(rng.randrange(1, 9))} {cue.partition('{}')[0]}"
                plants.append((len(docs), kind, len(before), len(before) + len(value)))
                docs.append(before + value + cue.partition("{}")[2] + " " + fill(3))
    for value in sum(UNSEEN.values(), []):  # the same shapes where nothing tells them
        docs.append(f"{fill(5)} {value} {fill(5)}")
    docs += [fill(200) for _ in range(30)] + ["", None, " \n"]
    return [(i, t) for i, t in enumerate(docs)] + [(3, docs[3]), (None, docs[5])], plants


def found_in(spark, docs):
    rows = spark.createDataFrame([(i, t, "r", 1, "v", 2) for i, t in docs], SCHEMA).repartition(4)
    return pii.find_pii(rows).collect()


def spans_of(text):
    return {(k, int(s), int(e)) for k, s, e in (x.split(":") for x in text.split(",") if x)}


def test_unseen_identifiers_of_many_shapes(spark, planted):
    docs, plants = planted
    rows = found_in(spark, docs)
    texts, added = dict(docs), set()
    for r in rows:
        base = {(pii.KINDS[k], s, e) for s, k, e in pii.base_spans(texts[r.doc_id] or "")}
        assert base <= spans_of(r.spans) and r.n_spans == len(spans_of(r.spans)) == len(base) + r.n_added
        if r.doc_id is not None:
            added |= {(r.doc_id, *s) for s in spans_of(r.spans) - base}
    hits = {a for a in added if a in {(d, k, s, e) for d, k, s, e in plants} or any(a[0] == d and a[1] == k and s <= a[2] + 4 and a[3] <= e and e - s - (a[3] - a[2]) <= 4 for d, k, s, e in plants)}
    assert len(hits) >= 0.9 * len(plants)
    assert len(hits) >= 0.9 * len(added)


def plain_graph(docs):
    """The accepted (value, kind) by a graph of Python dicts; its patterns are tuples of words."""
    norm = lambda w: re.sub("[0-9]", "0", w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    seeds, places, total, open_ = defaultdict(lambda: defaultdict(Counter)), Counter(), Counter(), defaultdict(Counter)
    texts = [(t, [(m.start(), m.end(), norm(m[0])) for m in re.finditer(r"[^\x20\x09-\x0D]+", t)]) for _, t in docs if t]

    def around(words, i, j):
        out = []
        if i > 0:
            out.append((1, words[i - 1][2]))
            out.append((3, words[i - 1][2], words[j][2] if j < len(words) else None))
        if i > 1:
            out.append((2, words[i - 2][2], words[i - 1][2]))
        return out

    for t, words in texts:
        for s, k, e in pii.base_spans(t):
            i = max(n for n, w in enumerate(words) if w[0] <= s)
            j = max(n for n, w in enumerate(words) if w[0] < e) + 1
            for p in around(words, i, j):
                seeds[p][k][t[s:e]] += 1
                places[p] += 1
    slots = []
    for t, words in texts:
        base = pii.base_spans(t)
        for i in range(len(words)):
            for m in range(1, pii.SLOT + 1):
                if i + m <= len(words):
                    for p in around(words, i, i + m):
                        if m == 1 or p[0] == 3:
                            total[p] += 1
                            value = t[words[i][0] : words[i + m - 1][1]].strip(pii.EDGES)
                            s = t.index(value, words[i][0]) if value else 0
                            if 4 <= len(value) <= pii.LENGTH and any(map(str.isalnum, value)) and not any(a < s + len(value) and s < b for a, _, b in base):
                                slots.append((p, value))
    good = {p for p in seeds if len(set().union(*seeds[p].values())) >= pii.SUPPORT and places[p] >= pii.FLOOR * max(places[p], total[p])}
    for p, value in slots:
        if p in good:
            open_[p][value] += 1
    used = {(p, k): sum(v.values()) for p in good if open_[p] for k, v in seeds[p].items() if len(v) >= pii.SUPPORT}
    size = {p: max(places[p], total[p]) for p in good}
    sure: dict = {}
    for _ in range(pii.ROUNDS):
        trust = {(p, k): round((n + sum(c * sure.get((v, k), 0) for v, c in open_[p].items())) / (size[p] + pii.CAUTION), 9) for (p, k), n in used.items()}
        doubt = defaultdict(float)
        for (p, k), c in trust.items():
            for v in open_[p]:
                doubt[v, k] += math.log(1 - min(c, 0.999))
        sure = {vk: 1 - math.exp(x) for vk, x in doubt.items()}
    best: dict = {}
    for (v, k), c in sure.items():
        best[v] = max(best.get(v, (-1, 0)), (round(c, 6), -k))
    return {(v, -k) for v, (c, k) in best.items() if c >= pii.SURE}


def test_accepted_instances_equal_a_plain_graph(spark, planted):
    docs, _ = planted
    texts, got = dict(docs), set()
    for r in found_in(spark, docs):
        if r.doc_id is not None:
            base = {(pii.KINDS[k], s, e) for s, k, e in pii.base_spans(texts[r.doc_id] or "")}
            got |= {(texts[r.doc_id][s:e], pii.KINDS.index(k)) for k, s, e in spans_of(r.spans) - base}
    want = plain_graph(docs)
    assert got <= want
    # what is accepted but lies within a longer span isn't shown
    assert all(any(v in g for g, _ in got) for v, _ in want - got)
