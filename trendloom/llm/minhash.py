"""Near duplicates by SuperMinHash signatures, banding, exact verification and union-find.

Texts with the same words are one class, represented by its smallest id. A
class's shingles each walk their own pseudo-random permutation of the
signature's components, offering the value (step + a fraction) to the component
met at each step; the walks stop once no component can get smaller. Bands of
five components are bucket keys. In each bucket every member is paired with the
smallest; pairs are confirmed on full shingle sets and grouped by union-find.
Where a bucket's members are still in different groups, an exact prefix join
over their full sets finds the pairs that could join groups, and these are
confirmed too: members of one group are never paired with one another, and no
link between groups is left out. The number of bands follows the threshold: a
pair at the threshold shares no band with a probability below ``MISS``. What is
sent to all tasks are tables of fixed size: the bits of the documents whose sets
are wanted, and the rarity of shingles by hash bucket.

Defined results: a text that is null or has no words has an empty set, is
linked with nothing and kept; a row without id takes no part and is kept, its
component null; rows that repeat an id and text are one document, texts that
share an id only are documents of their own (linked by their texts; components
are still named by ids); an empty table gives no rows. Very long texts are read whole.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm.common import COUNTS, MULTIPLIER, Tokenizer, byte_table, count_hashes, distinct, keyed, map_batches, mix64, rarity_table, shingle_hashes, slim, stage
from trendloom.llm.graph import components

#: Components of a band, and the chance that a pair at the threshold shares no band.
ROWS, MISS = 5, 1e-6
#: Shingles that walk at once (bounds memory for very long texts).
BLOCK = 1 << 15
#: Texts or sets that are worked on at once.
TEXTS = 1024
#: Size, as a power of two, of the tables that are sent to all tasks.
TABLE_BITS = 22


def bands_for(threshold: float) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - threshold**ROWS))


def super_min_hash(elements: np.ndarray, size: int) -> np.ndarray:
    """Signature of a set of distinct uint64: component values as step * 2^32 + fraction."""
    sig = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(elements), BLOCK):
        x = elements[at : at + BLOCK]
        walk, rows = None, np.arange(len(x))
        for j in range(size):
            draw = mix64(x + np.uint64(0x9E3779B97F4A7C15 * (j + 1) % 2**64))
            k = j + (((draw & np.uint64(0xFFFFFFFF)) * np.uint64(size - j)) >> np.uint64(32)).astype(np.int64)
            if j == 0:
                met, first = k, k
            else:
                if walk is None:
                    walk = np.tile(np.arange(size, dtype=np.int16), (len(x), 1))
                    walk[rows, first] = 0
                met = walk[rows, k].astype(np.int64)
                walk[rows, k] = walk[:, j]
            np.minimum.at(sig, met, (draw >> np.uint64(32)) | np.uint64(j << 32))
            if int(sig.max()) < (j + 1) << 32:  # early stop: later steps are larger everywhere
                break
    return sig


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    rows = sig.reshape(bands, -1)
    key = mix64(np.arange(1, bands + 1, dtype=np.uint64))
    for c in range(rows.shape[1]):
        key = mix64(key * MULTIPLIER + rows[:, c])
    return key.view(np.int64)


def _signatures(k: int, bands: int):
    def make():
        tokens = Tokenizer()

        def one(ids, texts):
            digest, n, keys = [], [], []
            for block in tokens.blocks(texts):
                h, at = block.hashes, block.bounds
                place = np.arange(len(h), dtype=np.uint64)
                for i, j in zip(at[:-1], at[1:], strict=True):
                    s = distinct(shingle_hashes(h[i:j], k))
                    x = h[i:j] + (place[: j - i] + np.uint64(1)) * MULTIPLIER  # words in their order
                    digest.append(np.array([mix64(x).sum(), mix64(x ^ MULTIPLIER).sum(), j - i], np.uint64).tobytes())
                    n.append(len(s))
                    keys.append(band_keys(super_min_hash(s, bands * ROWS), bands) if len(s) else None)
            return {"doc_id": ids, "digest": digest, "n_shingles": n, "bands": keys}

        return one

    return make


def place_of(ids: np.ndarray) -> np.ndarray:
    """The bit of a document in the table of candidates."""
    return (mix64(ids.astype(np.int64).view(np.uint64) * MULTIPLIER) & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64)


def _bits():
    return lambda ids: {"bucket": place_of(ids.to_numpy()).astype(np.int32)}


def _sets(k: int, wanted: np.ndarray):
    """The shingle sets of the documents whose bit is set."""

    packed = np.packbits(wanted)  # what travels to the tasks

    def make():
        tokens, wanted = Tokenizer(), np.unpackbits(packed)

        def one(ids, texts):
            hit = np.flatnonzero(wanted[place_of(ids.to_numpy(zero_copy_only=False))])
            some = texts.take(pa.array(hit))
            sets = [distinct(shingle_hashes(b.hashes[i:j], k)).view(np.int64) for b in tokens.blocks(some) for i, j in zip(b.bounds[:-1], b.bounds[1:], strict=True)]
            return {"id": ids.take(pa.array(hit)), "s": sets}

        return one

    return make


def _prefixes(levels: np.ndarray, percent: int):
    """Of each set, ordered by rarity, the first n - ceil(t n) + 1 shingles that another set may hold."""

    def make():
        def one(ids, sets):
            out: dict[str, list] = {c: [] for c in ("word", "id", "n", "at")}
            flat, ends = sets.values.to_numpy(zero_copy_only=False).view(np.uint64), sets.offsets.to_numpy()
            for i, lo, hi in zip(ids.to_numpy(), ends[:-1], ends[1:], strict=True):
                s, n = flat[lo:hi], int(hi - lo)
                level = levels[(s & np.uint64(len(levels) - 1)).astype(np.int64)]
                order = np.lexsort((s, level))[: n - -(-n * percent // 100) + 1]
                at = np.flatnonzero(level[order] > 1)
                out["word"].append(s[order[at]].view(np.int64))
                out["at"].append(at)
                out["id"].append(np.full(len(at), i, np.int64))
                out["n"].append(np.full(len(at), n, np.int64))
            return {c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in out.items()}

        return one

    return make


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of ids whose full sets have 100 * intersection >= percent * union."""
    left, right = sets.toDF("a", "s"), sets.toDF("b", "t")
    both = F.size(F.array_intersect("s", "t"))
    return pairs.join(left, "a").join(right, "b").where(100 * both >= percent * (F.size("s") + F.size("t") - both)).select("a", "b")


def apart(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of (id, g) with different g whose sets may be similar: an exact prefix join with length and position filters.

    Texts that differ in a few places each have rare shingles of their own. These
    come first, and are dropped as no other set holds them; what the texts share
    comes too late for the positions to allow the overlap asked for.
    """
    some = stage(sets.join(open_.select("id"), "id", "left_semi"), "mh-open-sets")
    count = lambda batches: count_hashes(batches, lambda b: [b.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64)], TABLE_BITS)
    levels = rarity_table(some.select("s").mapInArrow(count, COUNTS), TABLE_BITS)
    entries = stage(map_batches(some, "word long, id long, n long, at long", _prefixes(levels, percent), TEXTS).join(open_, "id"), "mh-entries")
    x, y = entries.alias("x"), entries.alias("y")
    both = F.col("x.n") + F.col("y.n")
    near = (
        (F.col("x.word") == F.col("y.word"))
        & (F.col("x.id") < F.col("y.id"))
        & (F.col("x.g") != F.col("y.g"))
        & (100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n"))
        & ((100 + percent) * F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at")) >= percent * both)
    )
    return x.join(y, near).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()


def near_duplicates(docs: DataFrame, k: int = 3, percent: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    flat, parted = keyed(docs)
    found = _linked(slim(flat, docs), k, percent)
    if not parted:
        return found
    names = flat.select(F.col("key").alias("doc_id"), F.col("c0").cast("long").alias("name")).where("name IS NOT NULL").distinct()
    found = stage(found.join(names, "doc_id", "left"), "mh-named-rows")
    least = found.groupBy("component_id").agg(F.min("name").alias("least"))
    out = found.join(least, "component_id", "left").select(F.col("name").alias("doc_id"), "n_shingles", F.col("least").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _linked(docs: DataFrame, k: int, percent: int) -> DataFrame:
    rows = stage(map_batches(docs, "doc_id long, digest binary, n_shingles long, bands array<long>", _signatures(k, bands_for(percent / 100)), TEXTS), "mh-rows")
    full = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stage(full.groupBy("digest").agg(F.min("doc_id").alias("rep")), "mh-classes")
    chosen = full.join(classes.select("digest", F.col("rep").alias("doc_id")), ["digest", "doc_id"], "left_semi")
    banded = stage(chosen.select(F.col("doc_id").alias("id"), F.explode("bands").alias("key")).distinct(), "mh-bands")
    buckets = stage(banded.groupBy("key").agg(F.min("id").alias("low"), F.count("*").alias("size")).where("size > 1"), "mh-buckets")
    member = stage(banded.join(buckets, "key"), "mh-members")
    wanted = byte_table(map_batches(member.select("id").distinct(), "bucket int", _bits).distinct().withColumn("on", F.lit(1)), "on", TABLE_BITS)
    sets = stage(map_batches(docs.where("doc_id IS NOT NULL"), "id long, s array<long>", _sets(k, wanted), TEXTS), "mh-sets")

    star = member.where("id <> low").select(F.col("low").alias("a"), F.col("id").alias("b")).distinct()
    links = stage(confirm(star, sets, percent), "mh-links")
    groups = stage(components(links, "mh-cc"), "mh-groups")

    named = stage(member.join(groups.withColumnRenamed("node", "id"), "id", "left").select("key", "id", F.coalesce("component", "id").alias("g")), "mh-named")
    mixed = stage(named.groupBy("key").agg(F.min("g").alias("p"), F.max("g").alias("q"), F.count("*").alias("c")).where("p <> q AND c > 2").select("key"), "mh-mixed")
    open_ = stage(named.join(mixed, "key", "left_semi").select("id", "g").distinct(), "mh-open")
    if not open_.isEmpty():
        more = stage(confirm(apart(open_, sets, percent), sets, percent), "mh-more")
        if not more.isEmpty():
            groups = stage(components(links.unionByName(more), "mh-cc"), "mh-groups")

    class_of = classes.join(groups.withColumnRenamed("node", "rep"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("component"))
    class_of = stage(class_of, "mh-class-of")
    out = rows.select("doc_id", "digest", "n_shingles").join(class_of, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
