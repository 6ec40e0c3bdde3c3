"""Texts that share an id, pruning that loses nothing, and what searches evaluate."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from trendloom.llm import decontaminate, knn, lines, minhash
from trendloom.llm.common import BitTable, keyed, map_batches, mix64, table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, c0 string"


def rows(spark, given):
    return spark.createDataFrame([(i, t, "en", "s", 1, "k", "c") for i, t in given], SCHEMA)


@pytest.fixture(scope="module")
def words():
    return [f"w{i}" for i in range(400)]


def test_keys_part_texts_that_share_an_id(spark, words):
    given = [(1, "a"), (1, "a"), (2, "b"), (2, "c"), (2, "c"), (None, "d"), (None, "e"), (3, None), (3, "x")]
    flat, parted = keyed(rows(spark, given))
    keys = {(r.c0, r.c1): r.key for r in flat.collect()}
    assert parted and keys[1, "a"] == 1 and keys[None, "d"] is None
    mine = [keys[2, "b"], keys[2, "c"], keys[3, None], keys[3, "x"]]
    assert len(set(mine)) == 4 and all(k >= 1 << 62 for k in mine)
    assert not keyed(rows(spark, given[:3]))[1]


def test_near_duplicates_of_texts_that_share_an_id(spark, words):
    rng = random.Random(1)
    x, y, z = (" ".join(rng.choice(words) for _ in range(80)) for _ in range(3))
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in minhash.near_duplicates(rows(spark, [(3, x), (7, x + " more"), (7, y), (9, y), (8, z)])).collect()}
    assert sorted(got.values()) == [(3, False), (3, True), (7, False), (7, True), (8, True)]


def test_near_dedup_keeps_what_shares_an_id_only(spark, words):
    rng = random.Random(2)
    x, y = (" ".join(rng.choice(words) for _ in range(60)) for _ in range(2))
    kept = corpus_pipeline.near_dedup(spark, rows(spark, [(3, x), (7, x), (7, y), (7, y), (None, x)]), SF)
    assert sorted((tuple(r)[:2] for r in kept.collect()), key=repr) == sorted([(3, x), (7, y), (None, x)], key=repr)
    assert kept.columns == SCHEMA.replace(" string", "").replace(" long", "").split(", ")


def test_lines_of_texts_that_share_an_id(spark):
    shared, own = "this very line stands in many documents", "and this one stands in a single place only"
    given = [(1, f"{shared}\nfirst line of document one"), (5, f"some other words here\n{shared}"), (5, f"quite different words there\n{own}"), (5, f"quite different words there\n{own}")]
    want = sorted([(1, 0, given[0][1]), (5, 1, "some other words here"), (5, 0, given[2][1]), (5, 0, given[3][1])])
    assert sorted((r.doc_id, r.n_removed, r.text) for r in lines.dedup_lines(rows(spark, given)).collect()) == want
    left = lines.drop_lines(rows(spark, given).withColumn("_doc", F.lit("mine")).withColumn("_gone", F.lit(4)))
    assert sorted((r.doc_id, r.text, r._doc, r._gone) for r in left.collect()) == sorted((i, t, "mine", 4) for i, _, t in want)


def test_decontamination_stage_keeps_what_shares_an_id_only(spark, given_items):
    item, clean = given_items
    kept = corpus_pipeline.decontamination(spark, rows(spark, [(1, clean), (7, f"{clean} {item} {clean}"), (7, clean + " end"), (None, clean)]), SF)
    assert sorted((tuple(r)[:2] for r in kept.collect()), key=repr) == sorted([(1, clean), (7, clean + " end"), (None, clean)], key=repr)


@pytest.fixture(scope="module")
def given_items(spark):
    items = [r.text for r in table(spark, SF, "benchmark").collect()]
    return max(items, key=len), " ".join(f"plain{i % 37}" for i in range(90))


@pytest.mark.parametrize("seed", range(3))
def test_line_rounds_equal_all_pairs(spark, seed):
    """Families of lines in which the likest earlier line isn't similar, but another is."""
    rng = random.Random(seed)
    base = [[rng.choice("abcdefghij") + str(rng.randrange(40)) for _ in range(14)] for _ in range(12)]
    texts = {}
    for i in range(60):
        some = []
        for _ in range(rng.randrange(1, 8)):
            line = list(rng.choice(base))
            for _ in range(rng.randrange(5)):
                line[rng.randrange(len(line))] = rng.choice("abcdefghij") + str(rng.randrange(40))
            rng.shuffle(line)
            some.append(" ".join(line))
        texts[i] = "\n".join(some)
    got = {r.doc_id: (r.text, r.n_removed) for r in lines.dedup_lines(rows(spark, texts.items())).collect()}
    assert got == brute.kept_lines(texts)


def test_the_index_of_items_loses_no_match(spark):
    """Every pair that passes the check on words passes the index, for random texts with planted parts of items."""
    rng = random.Random(8)
    vocab = [f"v{i}".encode() for i in range(120)] + [b"the", b"of", b"a,", b"(an)", b"..."]
    items = [decontaminate.bare([rng.choice(vocab) for _ in range(rng.randrange(3, 50))]) for _ in range(60)]
    index, held = decontaminate.Index(items), 0
    for _ in range(150):
        text = [rng.choice(vocab) for _ in range(rng.randrange(0, 150))]
        item = rng.choice(items)
        part = [w for w in item if rng.random() < rng.choice([1.0, 0.8, 0.65])]
        at = rng.randrange(len(text) + 1)
        clean = decontaminate.bare(text[:at] + part + text[at:])
        ids = index.ids(decontaminate.hash_words([w for w in clean if w]))
        possible = set(index.possible(ids))
        for i, it in enumerate(items):
            size = len(it)
            for p in range(0, max(1, len(clean)), decontaminate.STEP):
                around = clean[max(0, p - size) : p + decontaminate.SPAN + size]
                real = [w for w in it if w]
                if real and sum(w in set(real) for w in around) >= decontaminate.PARAPHRASED * size and decontaminate.lcs(it, around) >= decontaminate.PARAPHRASED * size:
                    held += 1
                    assert i in possible
    assert held > 100


def test_the_index_counts_a_word_as_often_as_in_both():
    """A text that repeats one of an item's words, the others far apart, can't hold the item."""
    item = [b"the"] + [b"a%d" % i for i in range(9)]
    index = decontaminate.Index([item, [b"b", b"c"]])
    ids = lambda words: index.ids(decontaminate.hash_words(words))
    assert index.possible(ids([w for a in item[1:] for w in [b"the"] * 60 + [a]])) == []
    assert index.possible(ids([b"the"] * 60 + item[:6] + [b"the"] * 60)) == [0]
    assert index.possible(ids([b"x"] * 9 + item + [b"c", b"b"])) == [0, 1]


def test_texts_are_worked_on_a_part_of_a_batch_at_a_time(spark, monkeypatch):
    """Sets and signatures are made for so many texts at once, however many a batch has."""
    asked = {}

    def record(df, schema, make, rows=None):
        asked[make.__qualname__.split(".")[0]] = rows
        return map_batches(df, schema, make, rows)

    for module in (lines, minhash, decontaminate):
        monkeypatch.setattr(module, "map_batches", record)
    docs = spark.createDataFrame([(i, f"some words that are the same {i % 3} and more of them {i}\nline {i}") for i in range(9)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "some words that are the same")], "item_id long, text string")
    minhash.near_duplicates(docs, k=2, percent=50).count()
    lines.dedup_lines(docs).count()
    decontaminate.contaminated(docs, items).count()
    made = {n: asked[n] for n in ("_signatures", "_sets", "_prefixes", "_full_sets", "_coded", "_search")}
    assert all(n and n <= 1024 for n in made.values()), made


def test_bit_tables_hold_all_that_was_put_in(spark):
    hashes = spark.range(5000).select(F.xxhash64("id").alias("h"))
    t = BitTable.of(hashes, 5000)
    mine = np.array([r.h for r in hashes.collect()], np.int64).view(np.uint64)
    assert t.holds(mine).all()
    assert t.holds(mix64(np.arange(100_000, dtype=np.uint64))).mean() < 0.05
    assert not BitTable.of(hashes.limit(0), 0).holds(mine).any()


def test_clustered_vectors_are_compared_with_few(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((60, 16)) * 8
    x = centres[rng.integers(0, 60, 9000)] + rng.standard_normal((9000, 16)) * 0.3
    df = spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    join = knn.prepare(df)
    assert join.evaluated() < 0.25
    q = np.floor(x * 256).astype(np.int64)
    want = set()
    for i in range(0, 9000, 50):
        s = q @ q[i]
        order = [j for j in np.lexsort((np.arange(9000), -s)) if j != i][:5]
        want |= {(i, r + 1, int(j), int(s[j])) for r, j in enumerate(order)}
    assert {tuple(r) for r in knn.top_k(df).select("query_id", "rank", "vec_id", "score").collect()} == want


def test_the_latent_space_is_fitted_to_all_passages(spark):
    """Each text's own word has a place in the space, however many passages there are."""
    rows = [(i, f"own{i} " + " ".join(f"w{(i * 7 + j) % 3000}" for j in range(260))) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    df, n = decontaminate.document_frequency(docs)
    assert n == 4000
    space = decontaminate.latent_space(docs, docs.limit(0), np.log((n + 1) / (df + 1.0)) + 0.01)
    own = decontaminate.buckets_of([f"own{i}".encode() for i in range(4000)])
    assert (np.abs(space[own]).max(1) > 0).all()


def test_sums_by_word_hold_little_beside_their_table():
    """Beside the sums (8 bytes a value) and the vectors (4 bytes) a task holds little more than both again."""
    words = np.random.default_rng(5).integers(0, decontaminate.BUCKETS, 400_000).astype(np.uint16)
    batch = pa.RecordBatch.from_pydict({"words": pa.array([words.tobytes()], pa.binary())})
    tracemalloc.start()
    n = sum(b.num_rows for b in decontaminate._sums(decontaminate._gaussian, np.ones(decontaminate.BUCKETS))([batch]))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == decontaminate.BUCKETS
    assert most < 2.3 * 12 * decontaminate.BUCKETS * decontaminate.SKETCH


def test_sums_by_word_are_those_of_a_plain_product(spark):
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 50, n).astype(np.uint16) for n in (1, 23, 24, 25, 400, 7)]
    weight = rng.random(decontaminate.BUCKETS) + 0.1
    left = rng.standard_normal((decontaminate.BUCKETS, decontaminate.SKETCH)).astype(np.float32)
    batch = pa.RecordBatch.from_pydict({"words": pa.array([t.tobytes() for t in texts], pa.binary())})
    got = {r["bucket"]: np.frombuffer(r["v"], np.float32) for b in decontaminate._sums(lambda: left, weight)([batch]) for r in b.to_pylist()}
    want = np.zeros_like(left, np.float64)
    for t in texts:
        for i in range(0, len(t), decontaminate.SPAN):
            w = np.unique(t[i : i + decontaminate.SPAN])
            a = weight[w] / np.sqrt((weight[w] ** 2).sum())
            want[w] += a[:, None] * (a @ left[w])
    assert set(got) == set(np.flatnonzero(want.any(1)).tolist())
    assert all(np.allclose(v, want[b], atol=1e-3) for b, v in got.items())
