"""Personal data: base patterns, and identifiers found by bootstrapped contexts.

The base patterns (e-mail, IP address, card, phone) give the seeds. The words
around seeds are lexical patterns: one or two before, or one before and one
after. A pattern is taken up with at least ``SUPPORT`` different seeds that fill
at least ``FLOOR`` of its places in all texts. What stands in the place of a seed
at such a pattern is an instance in doubt, whatever its shape: a word, or up to
``SLOT`` words between the word before and the word after, of 4 to ``LENGTH``
characters. Instances and patterns form a graph, and rounds on it pass confidence
from the seeds over patterns to instances in doubt: a pattern's confidence for a
kind is the mean over all its places in all texts (1 for seeds), held against ``CAUTION``
unknown ones; an instance's is the noisy-or of its patterns'. An instance whose confidence for a
kind reaches ``SURE`` is a span of that kind at all its places by patterns (joined to
the documents by their texts' digests, as spans depend on the text alone); of
spans that overlap the first stays, and of those the longest.

Defined results: a null text counts as empty; without spans the lists are empty
strings and the hash is that of an empty string; positions are code points, ends
exclusive; repeated rows are judged one by one; a null id stays null.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.llm.common import MULTIPLIER, BitTable, Tokenizer, distinct, map_batches, mix64, stage

KINDS = ("email", "ip", "card", "phone")
#: Rounds over the graph, seeds a pattern needs and their least share of its places, unknown instances it is held against, confidence to accept.
ROUNDS, SUPPORT, FLOOR, CAUTION, SURE = 3, 5, 0.1, 1.0, 0.8
#: Words of an instance in doubt, and characters.
SLOT, LENGTH = 4, 64
#: Bits that a table of patterns has at least, as a power of two.
PART_BITS = 22

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits can only start a match, never be entered later: hence the look-behind, and no run is read twice.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
EDGES = " \t\n\x0b\x0c\r\"'()[]{}<>.,;:!?*|"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from their at signs."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place in KINDS, end) of the base patterns, in order."""
    out = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(not p[:-3].strip("0") and int(p[-3:]) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


_ZERO = np.arange(256, dtype=np.uint8)
_ZERO[48:58] = 48


def zeroed(texts: pa.Array) -> pa.Array:
    """The texts with 0 for every digit."""
    texts = pa.concat_arrays([texts.fill_null("").cast(pa.large_string())])
    _, offsets, data = texts.buffers()
    if data is None or not len(texts):
        return texts
    return pa.Array.from_buffers(pa.large_string(), len(texts), [None, offsets, pa.py_buffer(_ZERO[np.frombuffer(data, np.uint8)].tobytes())], offset=texts.offset)


def pattern_keys(h: np.ndarray, first: np.ndarray, stop: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(keys, whether there is one) of the patterns around words ``first`` to ``stop`` of documents that hold words ``lo`` to ``hi``:
    the word before; the two before; the one before and the one after (or the end)."""
    one, two, most = np.uint64(1), np.uint64(2), max(len(h) - 1, 0)
    before, earlier = h[np.maximum(first - 1, 0)], h[np.maximum(first - 2, 0)]
    after = np.where(stop < hi, h[np.minimum(stop, most)], one)
    with_after = mix64(mix64(before * MULTIPLIER + after) * MULTIPLIER + two + one)
    return [(mix64(before * MULTIPLIER + one), first > lo), (mix64(mix64(earlier * MULTIPLIER + before) * MULTIPLIER + two), first - 1 > lo), (with_after, first > lo)]


def _key(s: str) -> int:
    return xxhash.xxh3_64_intdigest(s.encode()) - (1 << 63)


def _digest(text: str | None) -> tuple[int, int]:
    """128 bits of a text, as two signed longs: what its spans are joined by."""
    d = xxhash.xxh3_128_intdigest((text or "").encode())
    return (d >> 64) - (1 << 63), (d & ((1 << 64) - 1)) - (1 << 63)


def _read():
    tokens = Tokenizer()

    def patterns(text: str, spans: list[tuple[int, int, int]]) -> list[list[int]]:
        """The patterns around spans, which may be parts of words."""
        (block,) = tokens.blocks(zeroed(pa.array([text])))
        at = np.cumsum([0] + [len(c.encode()) for c in text]) if not text.isascii() else np.arange(len(text) + 1)
        first = np.searchsorted(block.starts, at[[s for s, _, _ in spans]], "right") - 1
        stop = np.searchsorted(block.starts, at[[e for _, _, e in spans]] - 1, "right")
        zero = np.zeros(len(spans), np.int64)
        keys = pattern_keys(block.hashes, first, stop, zero, zero + len(block.hashes))
        return [[int(k[i]) for k, ok in keys if ok[i]] for i in range(len(spans))]

    def one(ids, texts):
        cols: dict[str, list] = {c: [] for c in ("d1", "d2", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "seen")}
        for text in texts.to_pylist():
            for c, d in zip(("d1", "d2"), _digest(text), strict=True):
                cols[c].append(d)
            spans = base_spans(text or "")
            for k, c in enumerate(("n_email", "n_ip", "n_card", "n_phone")):
                cols[c].append(sum(s[1] == k for s in spans))
            cols["base_sha256"].append(hashlib.sha256(joined(spans).encode()).hexdigest())
            cols["base"].append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
            held = [[np.uint64(p).astype(np.int64) for p in some] for some in patterns(text, spans)] if spans else []
            cols["seen"].append([{"kind": k, "value": _key(text[s:e]), "patterns": p} for (s, k, e), p in zip(spans, held, strict=True)])
        return {"doc_id": ids} | cols

    return one


class Patterns:
    """A set of patterns as two tables of bits, by the lower and by the upper half of their hashes: hardly any other pattern is held,
    as in texts there are many times more patterns than in the set."""

    def __init__(self, patterns: DataFrame):
        n = patterns.count()
        halves = (F.col("pattern"), F.shiftrightunsigned("pattern", 32))
        self.low, self.high = (BitTable.of(patterns.select(h.alias("h")), n, PART_BITS) for h in halves)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        out = self.low.holds(keys)
        out[out] = self.high.holds(keys[out] >> np.uint64(32))
        return out


def slots(tokens: Tokenizer, texts: pa.Array, table: Patterns):
    """(block, first, stop, keys, number of words) of all places of up to SLOT words at patterns that the table holds; the first
    two kinds of pattern hold single words only."""
    for block in tokens.blocks(zeroed(texts)):
        n = len(block.hashes)
        if not n:
            continue
        doc = np.repeat(np.arange(len(block.bounds) - 1), np.diff(block.bounds))
        first, lo, hi = np.arange(n), block.bounds[doc], block.bounds[doc + 1]
        for m in range(1, SLOT + 1):
            for kind, (keys, ok) in enumerate(pattern_keys(block.hashes, first, first + m, lo, hi)):
                if m == 1 or kind == 2:
                    hit = np.flatnonzero(ok & (first + m <= hi) & table.holds(keys))
                    if len(hit):
                        yield block, doc[hit], hit, hit + m, keys[hit]


def _totals(table: Patterns):
    """How often the table's patterns stand in a batch's texts."""

    def make():
        tokens = Tokenizer()

        def one(texts):
            keys = np.sort(np.concatenate([np.zeros(0, np.uint64), *(s[4] for s in slots(tokens, texts, table))]))
            some = distinct(keys)
            return {"pattern": some.view(np.int64), "n": np.diff(np.append(np.searchsorted(keys, some), len(keys)))}

        return one

    return make


def _instances(table: Patterns):
    """Instances in doubt at the table's patterns, but for those that overlap a base span."""

    def make():
        tokens = Tokenizer()

        def one(texts):
            found: dict[tuple[int, int, int], list[int]] = {}
            for block, doc, first, stop, keys in slots(tokens, texts, table):
                for d, i, j, k in zip(doc.tolist(), first.tolist(), stop.tolist(), keys.view(np.int64).tolist(), strict=True):
                    begin = int(block.starts[i] - block.edges[d])
                    last = int(block.starts[j - 1] - block.edges[d])
                    found.setdefault((block.first + d, begin, last), []).append(k)
            out: dict[str, list] = {c: [] for c in ("d1", "d2", "start", "end", "value", "patterns")}
            now, text, raw, spans, digest = None, "", b"", [], (0, 0)
            for (d, begin, last), patterns in sorted(found.items()):
                if d != now:
                    now, text = d, texts[d].as_py()
                    raw, spans, digest = text.encode(), base_spans(text), _digest(text)
                end = re.compile(rb"[^\x20\x09-\x0D]*").match(raw, last).end()
                slot = raw[begin:end].decode()
                value = slot.strip(EDGES)
                if not 4 <= len(value) <= LENGTH or not any(map(str.isalnum, value)):
                    continue
                start = len(raw[:begin].decode()) + slot.index(value)
                if any(s < start + len(value) and start < e for s, _, e in spans):
                    continue
                for c, v in zip(out, (*digest, start, start + len(value), _key(value), patterns), strict=True):
                    out[c].append(v)
            return out

        return one

    return make


def spread(seeds: DataFrame, doubt: DataFrame) -> DataFrame:
    """Patterns of seeds (pattern, kind, held: places of seeds, n: all places) and instances in doubt (pattern, value, places)
    -> (value, kind, confidence) of the instances accepted."""
    found = None
    for _ in range(ROUNDS):
        patterns = seeds.withColumn("more", F.lit(0.0))
        if found is not None:
            gained = doubt.join(found, "value").groupBy("pattern", "kind").agg(F.sum(F.col("confidence") * F.col("places")).alias("more"))
            patterns = seeds.join(gained, ["pattern", "kind"], "left").withColumn("more", F.coalesce("more", F.lit(0.0)))
        patterns = patterns.select("pattern", "kind", F.round((F.col("held") + F.col("more")) / (F.col("n") + CAUTION), 9).alias("p"))
        noisy = 1 - F.exp(F.sum(F.log(1 - F.least("p", F.lit(0.999)))))
        found = stage(doubt.join(patterns, "pattern").groupBy("value", "kind").agg(noisy.alias("confidence")), "pii-found")
    best = found.groupBy("value").agg(F.max_by("kind", F.struct(F.round("confidence", 6), -F.col("kind"))).alias("kind"), F.max("confidence").alias("confidence"))
    return best.where(F.round("confidence", 6) >= SURE)


def find_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, counts and hash of the base spans, spans with those the contexts add, n_spans (all), n_added."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    span = "struct<start:int,kind:int,end:int>"
    seen = "struct<kind:int,value:long,patterns:array<long>>"
    read = stage(map_batches(rows, f"doc_id long, d1 long, d2 long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base array<{span}>, seen array<{seen}>", _read), "pii-read")
    seeds = stage(read.select(F.explode("seen").alias("s")).select("s.*").select(F.explode("patterns").alias("pattern"), "value", "kind"), "pii-seed-edges")
    # patterns with enough different seeds that fill enough of their places
    known = stage(seeds.groupBy("pattern").agg(F.count_distinct("value").alias("seeds"), F.count("*").alias("places")).where(F.col("seeds") >= SUPPORT), "pii-known")
    texts = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("text"))
    everywhere = map_batches(texts, "pattern long, n long", _totals(Patterns(known))).groupBy("pattern").agg(F.sum("n").alias("n"))
    total = F.greatest("places", F.coalesce("n", F.lit(0)))
    good = known.join(everywhere, "pattern", "left").select("pattern", "places", total.alias("n")).where(F.col("places") >= FLOOR * F.col("n"))
    good = stage(good.select("pattern", "n"), "pii-good")
    doubt = stage(map_batches(texts, "d1 long, d2 long, start int, end int, value long, patterns array<long>", _instances(Patterns(good))), "pii-doubt")
    by_kind = seeds.groupBy("pattern", "kind").agg(F.count_distinct("value").alias("seeds"), F.count("*").alias("held")).where(F.col("seeds") >= SUPPORT)
    by_kind = stage(by_kind.join(good, "pattern").select("pattern", "kind", "held", "n"), "pii-patterns")
    open_ = doubt.select(F.explode("patterns").alias("pattern"), "value").groupBy("pattern", "value").agg(F.count("*").alias("places"))
    sure = spread(by_kind, stage(open_.join(good.select("pattern"), "pattern", "left_semi"), "pii-open"))
    added = doubt.select("d1", "d2", "start", "end", "value").distinct().join(sure.select("value", "kind"), "value").groupBy("d1", "d2").agg(F.collect_list(F.struct("start", "kind", "end")).alias("added"))  # of one document
    added = added.withColumn("added", apart("added"))
    out = read.join(added, ["d1", "d2"], "left").withColumn("added", F.coalesce("added", F.expr(f"CAST(array() AS array<{span}>)")))
    spans = F.array_join(F.transform(F.array_sort(F.concat("base", "added")), lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", spans.alias("spans"), (F.size("base") + F.size("added")).cast("long").alias("n_spans"), F.size("added").alias("n_added"))


def apart(spans: str) -> Column:
    """Of spans that overlap, the first; of those that begin together, the longest."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"))))
    none = F.expr("CAST(array() AS array<struct<start:int,kind:int,end:int>>)")

    def step(kept, s):
        last = F.coalesce(F.get(F.transform(kept, lambda k: k["end"]), F.size(kept) - 1), F.lit(-1))
        return F.when(s["start"] < last, kept).otherwise(F.concat(kept, F.array(F.struct(s["start"].alias("start"), s["kind"].alias("kind"), (-s["back"]).alias("end")))))

    return F.aggregate(order, none, step)
