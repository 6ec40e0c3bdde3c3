"""Line dedup: an exact set-similarity join over the lines of all documents.

A line is the set of its lower-cased words. Lines of equal sets are one class,
told by a 128-bit digest. The words of a line are ordered by rarity (the power
of two of their count, then their hash); two lines with Jaccard >= 4/5 share a
word among the first n - ceil(4n/5) + 1 of each. Only these prefixes are joined,
by word, under filters that lose nothing: length, position (words that can still
be shared) and a signature of 128 bits (bits that differ bound the words that
differ). Words that no other line has can't be shared and are left out.

A line goes if any earlier one (by doc_id, then line number) is similar to it, so one is
enough, and the lines of a large family of near copies are not paired with each other:
first, words are dealt to PARTS parts by their hash; lines that have the same words in
a part are sorted, and each is verified on the full sets with the first and the
previous of them only. Then only lines not told by that are joined with all earlier
ones, and verified where signatures of 256 bits leave it possible.

Two tables are sent to all tasks: the rarity of words by hash bucket (of fixed
size; buckets that words share make the order less sharp, nothing else), and
the bits of the lines whose full sets are wanted (sized from their number, up to
a bound; bits that lines share cost some sets that nobody asks for), and as such a
table the documents that hold them.

Defined results: blank lines are never similar to any and stay; a null text
stays null; rows without id are left as they are; rows that repeat an id and text
are one document (a line isn't compared with itself), texts that share an id only
are documents of their own, which come after all others; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm.common import COUNTS, MULTIPLIER, BitTable, Tokenizer, count_hashes, discard, distinct, keyed, map_batches, mix64, rarity_table, slim, stage

#: Buckets of the rarity table, as a power of two.
RARITY_BITS = 23
#: Texts whose sets are made at once.
TEXTS = 1024
#: Longs of a signature and of a wide one, parts that words are dealt to.
SHORT, WIDE, PARTS = 2, 4, 6
#: A prefix entry holds a set's size and a word's place in it in one number, up to these bounds (filters stay lossless beyond), and its sign tells lines told already.
SIZE_MOST, AT_BITS, TOLD = (1 << 19) - 1, 12, -(1 << 31)
#: Sort key: 12 bits line, 6 bits rarity, 46 bits of the word's hash; so 4096 lines are sorted at once.
LINES, TOKEN_BITS = 4096, 46


def rarity(docs: DataFrame) -> np.ndarray:
    """The rarity of words, counted over all documents."""

    def count(batches):
        tokens = Tokenizer()
        return count_hashes(batches, lambda b: (block.hashes for block in tokens.blocks(b.column(0))), RARITY_BITS)

    return rarity_table(docs.select("text").mapInArrow(count, COUNTS), RARITY_BITS)


def line_sets(block, levels: np.ndarray | None):
    """Sets of the block's lines, LINES at a time: (document in the block, line number, sort key, owner, set sizes, set starts)."""
    doc = np.searchsorted(block.edges, block.starts, "right") - 1
    before = np.searchsorted(block.lines, block.starts)  # line ends before the word
    number = before - np.searchsorted(block.lines, block.edges)[doc]
    if not len(doc):
        return
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (number[1:] != number[:-1])])
    first = np.flatnonzero(new)
    line = np.cumsum(new) - 1
    for at in range(0, len(first), LINES):
        lo, hi = first[at], first[at + LINES] if at + LINES < len(first) else len(doc)
        h = block.hashes[lo:hi]
        key = ((line[lo:hi] - at).astype(np.uint64) << np.uint64(64 - 12)) | (h >> np.uint64(64 - TOKEN_BITS))
        if levels is not None:
            key |= levels[(h & np.uint64(len(levels) - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(TOKEN_BITS)
        key = distinct(key)
        owner = (key >> np.uint64(64 - 12)).astype(np.int64)
        start = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        heads = first[at : at + LINES]
        yield doc[heads], number[heads], key, owner, np.diff(np.append(start, len(key))), start


def signature(token: np.ndarray, start: np.ndarray, longs: int, shift: int) -> list[np.ndarray]:
    """Of each set, the bits that its words have in so many longs."""
    place = (token >> np.uint64(shift)) & np.uint64(64 * longs - 1)
    bit = np.uint64(1) << (place & np.uint64(63))
    return [np.bitwise_or.reduceat(np.where(place >> np.uint64(6) == np.uint64(j), bit, np.uint64(0)), start).view(np.int64) for j in range(longs)]


def part_keys(token: np.ndarray, owner: np.ndarray, lines: int) -> np.ndarray:
    """Of each of the lines, a hash of the words in each part, 0 if there are none."""
    h = mix64(token + MULTIPLIER)
    words = np.zeros(lines * PARTS, np.uint64)
    np.add.at(words, owner * PARTS + (h % np.uint64(PARTS)).astype(np.int64), mix64(h))
    name = np.tile(np.arange(PARTS, dtype=np.uint64), lines)
    return np.where(words == 0, np.uint64(0), mix64(words * MULTIPLIER + name)).view(np.int64)


def _prefixes(levels: np.ndarray):
    """For each line with words: its set's digest, size, signature and parts, and its prefix from word ``skip`` on."""

    def make():
        tokens = Tokenizer()

        def one(ids, texts):
            doc_id, parts = ids.to_numpy(zero_copy_only=False), []
            for block in tokens.blocks(texts):
                for doc, number, key, owner, n, start in line_sets(block, levels):
                    token = key & np.uint64((1 << TOKEN_BITS) - 1)
                    a, b = np.add.reduceat(mix64(token + np.uint64(1)), start), np.add.reduceat(mix64(token ^ MULTIPLIER), start)
                    sig = signature(token, start, SHORT, 0)
                    alone = ((key >> np.uint64(TOKEN_BITS)) & np.uint64(63)) == 1
                    skip = np.add.reduceat(alone.astype(np.int32), start)
                    use = (np.arange(len(key)) - start[owner] < (n - (4 * n + 4) // 5 + 1)[owner]) & ~alone
                    ids_ = doc_id[doc + block.first]
                    order = np.lexsort((number, ids_, b, a))  # copies seen here already need no words; all copies are told by their class
                    same = np.zeros(len(order), bool)
                    same[order[1:]] = (a[order[1:]] == a[order[:-1]]) & (b[order[1:]] == b[order[:-1]]) & (ids_[order[1:]] == ids_[order[:-1]]) & (number[order[1:]] != number[order[:-1]])  # not of rows that repeat
                    use &= ~same[owner]
                    asked = ~same & (n > 3)  # sets of three words and fewer are similar to equal ones only
                    keys = part_keys(token, owner, len(n)).reshape(-1, PARTS)[asked].ravel()
                    parts.append((ids_, number, a.view(np.int64), b.view(np.int64), n, sig[0], skip, np.add.reduceat(use.astype(np.int32), start), token[use].view(np.int64), sig[1], asked * PARTS, keys))
            col = lambda j, t=np.int64: np.concatenate([p[j] for p in parts]).astype(t) if parts else np.zeros(0, t)
            lists = lambda sizes, values: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(col(sizes))]), pa.int32()), pa.array(col(values), pa.int64()))
            return {"doc_id": col(0), "line": col(1, np.int32), "d1": col(2), "d2": col(3), "n": col(4, np.int32), "s0": col(5), "s1": col(9), "skip": col(6, np.int32), "words": lists(7, 8), "parts": lists(10, 11)}

        return one

    return make


def line_hash(doc_id: np.ndarray, line: np.ndarray) -> np.ndarray:
    return mix64(mix64(doc_id.astype(np.int64).view(np.uint64)) * MULTIPLIER + line.astype(np.int64).view(np.uint64))


def _hashed():
    return lambda ids, line: {"h": line_hash(ids.to_numpy(), line.to_numpy()).view(np.int64)}


def _hashed_documents():
    return lambda ids: {"h": mix64(ids.to_numpy().view(np.uint64)).view(np.int64)}


def _full_sets(wanted: BitTable, documents: BitTable):
    """The full sets of the lines that the table holds, in the documents that the other one holds."""

    def make():
        tokens = Tokenizer()

        def one(ids, texts):
            held = documents.holds(mix64(ids.to_numpy(zero_copy_only=False).view(np.uint64)))
            doc_id, parts = ids.to_numpy(zero_copy_only=False)[held], []
            for block in tokens.blocks(texts.filter(pa.array(held))):
                for doc, number, key, owner, n, start in line_sets(block, None):
                    ids_ = doc_id[doc + block.first]
                    hit = wanted.holds(line_hash(ids_, number))
                    token = key & np.uint64((1 << TOKEN_BITS) - 1)
                    wide = [s[hit] for s in signature(token, start, WIDE, 7)]  # other bits than those of the short one
                    parts.append((ids_[hit], number[hit], n[hit], token[hit[owner]].view(np.int64), *wide))
            col = lambda j, t=np.int64: np.concatenate([p[j] for p in parts]).astype(t) if parts else np.zeros(0, t)
            ends = np.concatenate([[0], np.cumsum(col(2))]).astype(np.int32)
            return {f"s{j}": col(4 + j) for j in range(WIDE)} | {"doc_id": col(0), "line": col(1, np.int32), "n": col(2, np.int32), "w": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(col(3), pa.int64()))}

        return one

    return make


def _neighbours(batches):
    """Sorted (key, doc_id, line, n, s0, s1): each line with the first and the previous one of its key, where sizes and signatures leave it possible."""
    schema = pa.schema([("a", pa.int64()), ("i", pa.int32()), ("b", pa.int64()), ("j", pa.int32())])
    held = None  # the first line of the last key, and the last line
    for batch in batches:
        cols = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
        if held is not None:
            cols = [np.concatenate([h, c]) for h, c in zip(held, cols, strict=True)]
        lead = 0 if held is None else 2
        key, doc, line, n, s0, s1 = cols
        if len(key) <= lead:
            continue
        at = np.arange(len(key))
        head = np.maximum.accumulate(np.where(np.concatenate([[True], key[1:] != key[:-1]]), at, 0))
        here = np.concatenate([at[lead:], at[lead:]])
        there = np.concatenate([head[lead:], np.maximum(at[lead:] - 1, head[lead:])])
        there = np.where((doc[there] == doc[here]) & (line[there] == line[here]), head[here], there)  # rows that repeat are one
        bits = sum(np.bitwise_count((s[here] ^ s[there]).view(np.uint64)).astype(np.int64) for s in (s0, s1))
        near = (4 * np.maximum(n[here], n[there]) <= 5 * np.minimum(n[here], n[there])) & (9 * bits <= n[here] + n[there]) & ((doc[here] != doc[there]) | (line[here] != line[there]))
        here, there = here[near], there[near]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((doc[there], line[there], doc[here], line[here]), schema, strict=True)], schema=schema)
        held = [c[[head[-1], len(key) - 1]] for c in cols]


def neighbours(told: DataFrame) -> DataFrame:
    """(a, i, b, j): lines that have the same words in a part, the later with the first and the previous of them."""
    entries = told.select(F.explode("parts").alias("key"), "doc_id", "line", "n", "s0", "s1").where("key <> 0")
    order = ("key", "doc_id", "line")
    return entries.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_neighbours, "a long, i int, b long, j int").distinct()


def opened(told: DataFrame, known: DataFrame) -> DataFrame:
    """The lines with a prefix, ``open`` if they are not among the ``known`` (b, j)."""
    known = known.select(F.col("b").alias("doc_id"), F.col("j").alias("line"), F.lit(True).alias("known"))
    some = told.where("size(words) > 0").join(known, ["doc_id", "line"], "left")
    return some.select("doc_id", "line", "n", "s0", "s1", "skip", "words", F.col("known").isNull().alias("open"))


def candidate_pairs(lines: DataFrame) -> DataFrame:
    """(a, i, b, j): lines that share a prefix word and pass the filters, the earlier first, the later an open one."""
    meta = F.shiftleft(F.least("n", F.lit(SIZE_MOST)), AT_BITS).bitwiseOR(F.when(F.col("open"), 0).otherwise(TOLD))
    entries = lines.select("doc_id", "line", "s0", "s1", "skip", meta.alias("n"), F.posexplode("words").alias("at", "word"))
    entries = entries.select("word", "doc_id", "line", "s0", "s1", F.col("n").bitwiseOR(F.least(F.col("skip") + F.col("at"), F.lit((1 << AT_BITS) - 1))).alias("meta"))
    x, y = entries.alias("x"), entries.alias("y")
    # told lines have no size that is similar to any as the later ones; so both sides are one shuffle
    n = {"x": F.shiftright(F.col("x.meta").bitwiseAND(~TOLD), AT_BITS), "y": F.shiftright("y.meta", AT_BITS)}
    left = {s: n[s] - F.col(f"{s}.meta").bitwiseAND((1 << AT_BITS) - 1) for s in "xy"}
    both = n["x"] + n["y"]
    bits = F.bit_count(F.col("x.s0").bitwiseXOR(F.col("y.s0"))) + F.bit_count(F.col("x.s1").bitwiseXOR(F.col("y.s1")))
    near = (
        (F.col("x.word") == F.col("y.word"))
        & (4 * F.greatest(n["x"], n["y"]) <= 5 * F.least(n["x"], n["y"]))
        & (9 * bits <= both)
        & (9 * F.least(left["x"], left["y"]) >= 4 * both)
        & ((F.col("x.doc_id") < F.col("y.doc_id")) | ((F.col("x.doc_id") == F.col("y.doc_id")) & (F.col("x.line") < F.col("y.line"))))
    )
    return x.join(y, near).select(F.col("x.doc_id").alias("a"), F.col("x.line").alias("i"), F.col("y.doc_id").alias("b"), F.col("y.line").alias("j")).distinct()


def possible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, i, b, j) whose wide signatures don't rule out that their sets are similar."""
    wide = [f"s{j}" for j in range(WIDE)]
    left = sets.select(F.col("doc_id").alias("a"), F.col("line").alias("i"), F.col("n").alias("m"), *[F.col(c).alias(f"l{c}") for c in wide])
    right = sets.select(F.col("doc_id").alias("b"), F.col("line").alias("j"), "n", *wide)
    bits = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"l{c}"))) for c in wide[1:]), F.bit_count(F.col("s0").bitwiseXOR(F.col("ls0"))))
    return pairs.join(right, ["b", "j"]).join(left, ["a", "i"]).where(9 * bits <= F.col("m") + F.col("n")).select("a", "i", "b", "j")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(b, j) of the pairs (a, i, b, j) whose full sets are similar."""
    sets = sets.select("doc_id", "line", "w")
    left, right = sets.toDF("a", "i", "w"), sets.toDF("b", "j", "v")
    shared = F.size(F.array_intersect("w", "v"))
    similar = pairs.join(right, ["b", "j"]).join(left, ["a", "i"]).where(5 * shared >= 4 * (F.size("w") + F.size("v") - shared))
    return similar.select("b", "j").distinct()


def similar(docs: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """(b, j) of the pairs (a, i, b, j) of lines of ``docs`` that are similar."""
    ends = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("doc_id"), F.col("i").alias("line")), F.struct(F.col("b").alias("doc_id"), F.col("j").alias("line")))).alias("w")).select("w.*")
    ends = stage(ends.distinct(), f"ln-{name}-ends")
    hashes = map_batches(ends, "h long", _hashed)
    documents = stage(ends.select("doc_id").distinct(), f"ln-{name}-documents")
    wanted, held = BitTable.of(hashes, ends.count()), BitTable.of(map_batches(documents, "h long", _hashed_documents), documents.count())
    sets = stage(map_batches(docs, "doc_id long, line int, n int, s0 long, s1 long, s2 long, s3 long, w array<long>", _full_sets(wanted, held), TEXTS), f"ln-{name}-sets")
    left = stage(possible(pairs, sets), f"ln-{name}-left")
    found = stage(verified(left, sets), f"ln-{name}")
    for made in (ends, documents, sets, left):
        discard(made)
    return found


def later_matches(docs: DataFrame) -> DataFrame:
    """(doc_id, line) of every line that is similar to an earlier one; ``docs`` has doc_id and text."""
    docs = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    found = stage(map_batches(docs, "doc_id long, line int, d1 long, d2 long, n int, s0 long, s1 long, skip int, words array<long>, parts array<long>", _prefixes(rarity(docs)), TEXTS), "ln-lines")
    # only classes of several lines hold copies, and are joined
    classes = found.groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "line")).alias("first"), F.count("*").alias("several"))
    classes = stage(classes.where("several > 1").drop("several"), "ln-classes")
    copy = F.coalesce(F.struct("doc_id", "line") > F.col("first"), F.lit(False))
    lines = found.join(classes, ["d1", "d2"], "left").select("doc_id", "line", copy.alias("copy"), "n", "s0", "s1", "skip", F.when(~copy & (F.col("n") > 3), F.col("words")).alias("words"), F.when(~copy, F.col("parts")).alias("parts"))
    told = stage(lines, "ln-told")  # sets of three words and fewer are similar to equal ones only
    discard(found)
    discard(classes)
    # copies of a class's first line go with it or without it: they are copies anyway
    copies = stage(told.where("copy").select(F.col("doc_id").alias("b"), F.col("line").alias("j")), "ln-copies")
    links = stage(neighbours(told), "ln-links")
    first = similar(docs, links, "first")
    discard(links)
    lines = stage(opened(told, first), "ln-open")
    discard(told)
    pairs = stage(candidate_pairs(lines), "ln-pairs")
    discard(lines)
    more = similar(docs, pairs, "more")
    discard(pairs)
    return copies.unionByName(first).unionByName(more).toDF("doc_id", "line").distinct()


def _without(texts: pa.Array, gone: pa.Array) -> tuple[list, list, list]:
    """Texts without the lines listed, their line counts before, and how many went."""
    out, total, cut = [], [], []
    for text, g in zip(texts.to_pylist(), gone.to_pylist(), strict=True):
        total.append(0 if text is None else text.count("\n") + 1)
        cut.append(len(g or ()))
        if g:
            drop = set(g)
            text = "\n".join(p for i, p in enumerate(text.split("\n")) if i not in drop)
        out.append(text)
    return out, total, cut


def _with_gone(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """All columns of ``docs`` by position, and last the numbers of the lines that go."""
    flat, _ = keyed(docs, doc_id, text)
    gone = stage(later_matches(slim(flat, docs, text)).groupBy("doc_id").agg(F.collect_list("line").alias("gone")), "ln-gone")  # at most a document's lines
    return flat.join(gone.withColumnRenamed("doc_id", "key"), "key", "left").drop("key")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_removed, text without the removed lines."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def make():
        def one(ids, texts, lines):
            out, total, cut = _without(texts, lines)
            return {"doc_id": ids, "n_lines": total, "n_removed": cut, "text": out}

        return one

    return map_batches(_with_gone(docs, "doc_id", "text"), "doc_id long, n_lines int, n_removed int, text string", make)


def drop_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs``, all columns, without the removed lines; a document that loses all its words goes."""
    schema, at = docs.schema, docs.columns.index(text)

    def run(batches):
        for b in batches:
            out, _, cut = _without(b.column(at), b.column(b.num_columns - 1))
            cols = [pa.array(out, b.schema.field(i).type) if i == at else b.column(i) for i in range(b.num_columns - 1)]
            left = pa.RecordBatch.from_arrays(cols, schema=pa.schema([b.schema.field(i).with_name(schema[i].name) for i in range(b.num_columns - 1)]))
            yield left.filter(pa.array([not c or bool(t.strip(" \t\n\x0b\x0c\r")) for c, t in zip(cut, out, strict=True)], pa.bool_()))

    return _with_gone(docs, doc_id, text).mapInArrow(run, schema)
