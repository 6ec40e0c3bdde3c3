"""Benchmark decontamination by latent semantic retrieval.

Words are hashed to a fixed number of buckets, weighed by their inverse document
frequency over all documents. A randomised SVD of TF-IDF passages gives the
latent space: it is fitted to all passages of all documents and items (``SPAN``
words each, without overlap); tasks multiply their part with a seeded Gaussian and
with its transpose, and only the sums (buckets by columns) meet. Every passage of every document (``SPAN`` words,
starting every ``STEP`` words) is then projected and compared with the passages
of the benchmark's items (starting at every word); pairs whose cosine reaches
``NEAR`` are candidates. A candidate is checked on the words around it: the
longest common subsequence must hold ``COPIED`` of the item's words, or
``PARAPHRASED`` of them and the item's answer, its last sentence, word for word.

No pair can pass that check unless so many of the item's words stand together in
some stretch of the document; this is told from the words' hashes, for all items at
once, and pairs of which it doesn't hold aren't projected or compared.

What tasks are sent has a bound: buckets by columns, and ``ITEMS`` items; a
benchmark of more is searched for in so many passes.

Defined results: a text or item that is null or has no words matches nothing;
items shorter than a passage are matched as a whole; ties don't matter (every
pair is returned); rows that repeat give a pair once; a null id takes no part; an
empty table on either side gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm.common import Tokenizer, discard, distinct, hash_words, map_batches, stage, tidied, words_of
from trendloom.llm.passages import aligned, lcs, masks  # noqa: F401  (lcs is what ``aligned`` gives, for callers)

#: Buckets of words, columns of the sketch, dimensions kept.
BUCKETS, SKETCH, DIMS = 1 << 15, 112, 96
#: Passages whose products are summed by word at once, rows of vectors gathered at once (to stay within a core's cache), and places up to which words are summed together.
GROUP, CHUNK, FEW = 1 << 14, 1 << 11, 16
#: Buckets whose values are made or added at once.
ADDED = 1 << 10
#: Words of a passage and between their starts in a document (SPAN is a multiple; in an item they start at every word), items of a pass.
SPAN, STEP, ITEMS = 24, 8, 1 << 15
#: Least cosine of a candidate (for items shorter than a passage, less in proportion); shares of an item's words that count as copied, or as paraphrased.
NEAR, COPIED, PARAPHRASED = 0.4, 0.8, 0.6
SEED = 7


def buckets_of(words: list[bytes]) -> np.ndarray:
    return (hash_words(words) & np.uint64(BUCKETS - 1)).astype(np.int32)


def texts_of(tokens: Tokenizer, texts: pa.Array):
    """(index of the text, its words' buckets) of all texts of a batch."""
    for block in tokens.blocks(texts):
        b = (block.hashes & np.uint64(BUCKETS - 1)).astype(np.int32)
        for i, (lo, hi) in enumerate(zip(block.bounds[:-1], block.bounds[1:], strict=True), block.first):
            yield i, b[lo:hi]


def document_frequency(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents in which a bucket's words stand, and documents with words."""

    def run(batches):
        tokens, held, n = Tokenizer(), np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for block in tokens.blocks(batch.column(0)):
                sizes = np.diff(block.bounds)
                b = np.repeat(np.arange(len(sizes)) * BUCKETS, sizes) + (block.hashes & np.uint64(BUCKETS - 1)).astype(np.int64)
                held += np.bincount(distinct(b) % BUCKETS, minlength=BUCKETS)
                n += np.count_nonzero(sizes)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array([*some, -1], pa.int32()), "n": pa.array([*held[some], n], pa.int64())})

    found = docs.select("text").mapInArrow(tidied(run), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS + 1, np.int64)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out[:BUCKETS], int(out[-1])


def _coded():
    tokens = Tokenizer()
    return lambda texts: {"words": [b.astype(np.uint16).tobytes() for _, b in texts_of(tokens, texts) if len(b)]}


def _gaussian() -> np.ndarray:
    rng, out = np.random.default_rng(SEED), np.empty((BUCKETS, SKETCH), np.float32)
    for part in np.split(out, BUCKETS // ADDED):  # a part at a time, to hold less
        part[:] = rng.standard_normal(part.shape)
    return out


def _parts(texts: pa.Array):
    """The passages of the texts, GROUP or fewer at a time: rows of SPAN words in order, and 1 for those that stand there for the first time, else 0."""
    some, n = [], 0

    def rows():
        counts = np.array([-(-len(t) // SPAN) for t in some])
        filled = np.full(counts.sum() * SPAN, BUCKETS, np.int64)
        for t, at in zip(some, ((np.cumsum(counts) - counts) * SPAN).tolist(), strict=True):
            filled[at : at + len(t)] = t
        w = np.sort(filled.reshape(-1, SPAN), axis=1)
        use = w < BUCKETS
        use[:, 1:] &= w[:, 1:] != w[:, :-1]
        return np.where(use, w, 0), use.astype(np.float32)

    for t in texts:
        words = np.frombuffer(t.as_buffer(), np.uint16)
        for i in range(0, len(words), GROUP * SPAN):
            some.append(words[i : i + GROUP * SPAN])
            n += -(-len(some[-1]) // SPAN)
            if n >= GROUP:
                yield rows()
                some, n = [], 0
    if some:
        yield rows()


def _products(a: np.ndarray, left: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of each row of ``at``, the sum of these rows of ``left`` by the factors ``a``."""
    out = np.empty((len(at), left.shape[1]), np.float32)
    step = max(1, CHUNK // at.shape[1])
    held = np.empty((min(step, len(at)), at.shape[1], left.shape[1]), np.float32)
    for i in range(0, len(at), step):
        some = at[i : i + step]
        rows = held[: len(some)]
        np.take(left, some, axis=0, out=rows, mode="clip")  # in bounds anyway; "raise" would buffer
        np.matmul(a[i : i + step, None, :], rows, out=out[i : i + step, None, :])
    return out


def _by_word(w: np.ndarray, a: np.ndarray, y: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each word of ``w`` (sorted) once, and the sum of its rows of ``y`` by the factors ``a``: words of the same few places together, others by themselves."""
    first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
    counts = np.diff(np.append(first, len(w)))
    out = np.zeros((len(first), y.shape[1]), np.float32)
    for n in range(1, FEW + 1):
        some = np.flatnonzero(counts == n)
        if len(some):
            at = first[some, None] + np.arange(n)
            out[some] = _products(a[at], y, row[at])
    for i in np.flatnonzero(counts > FEW):
        for lo in range(first[i], first[i] + counts[i], CHUNK):
            hi = min(lo + CHUNK, first[i] + counts[i])
            out[i] += a[lo:hi] @ np.take(y, row[lo:hi], axis=0)
    return w[first], out


def _add(held: np.ndarray, left: np.ndarray, weigh: np.ndarray, w: np.ndarray, use: np.ndarray) -> None:
    """Adds A^T (A L) of the passages ``w``, ``use`` to ``held``."""
    a = weigh[w] * use
    a /= np.sqrt((a * a).sum(1, keepdims=True))
    y = _products(a, left, w)
    some = np.flatnonzero(use.ravel())
    some = some[np.argsort(w.ravel()[some].astype(np.uint16), kind="stable")]
    words, sums = _by_word(w.ravel()[some], a.ravel()[some], y, some // SPAN)
    for i in range(0, len(words), ADDED):
        held[words[i : i + ADDED]] += sums[i : i + ADDED]


def _sums(left_of, weight: np.ndarray):
    """Tasks' parts of A^T (A L): rows of (bucket, values)."""

    def run(batches):
        left, held, weigh = left_of(), np.zeros((BUCKETS, SKETCH)), weight.astype(np.float32)
        for batch in batches:
            for part in _parts(batch.column(0)):
                _add(held, left, weigh, *part)
        some = np.flatnonzero(held.any(1))
        for at in range(0, len(some), ADDED):
            part = some[at : at + ADDED]
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(part, pa.int32()), "v": pa.array([held[i].astype(np.float32).tobytes() for i in part], pa.binary())})

    return tidied(run)


def _added(batches):
    """Sorted (bucket, values): the sums of each bucket's values in a batch."""
    for b in batches:
        if b.num_rows:
            bucket = b.column(0).to_numpy()
            v = np.frombuffer(b"".join(b.column(1).to_pylist()), np.float32).reshape(len(bucket), -1)
            first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            sums = np.add.reduceat(v, first, axis=0, dtype=np.float64)
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(bucket[first], pa.int32()), "v": pa.array([r.tobytes() for r in sums], pa.binary())})


def latent_space(docs: DataFrame, items: DataFrame, weight: np.ndarray) -> np.ndarray:
    """Buckets by DIMS: the right singular vectors of all passages over their singular values, weighed."""
    texts = docs.select("text").unionByName(items.select("text"))
    rows = stage(map_batches(texts, "words binary", _coded, TEXTS), "dc-words")

    def multiply(left_of) -> np.ndarray:
        parts = rows.mapInArrow(_sums(left_of, weight), "bucket int, v binary")
        dealt = parts.repartition("bucket").sortWithinPartitions("bucket")
        out = np.zeros((BUCKETS, SKETCH))
        for r in stage(dealt.mapInArrow(_added, "bucket int, v binary"), "dc-sums").toLocalIterator():
            out[r.bucket] += np.frombuffer(r.v)
        return out

    q, _ = np.linalg.qr(multiply(_gaussian))
    q32 = q.astype(np.float32)
    small = multiply(lambda: q32)  # A^T A Q
    discard(rows)
    values, vectors = np.linalg.eigh(q.T @ small)
    keep = np.argsort(-values)[:DIMS]
    size = np.sqrt(np.maximum(values[keep], 1e-9 * max(values.max(), 1e-9)))  # dimensions count alike, else the commonest words decide all cosines
    return (weight[:, None] * (q @ vectors[:, keep]) / size).astype(np.float32)


def passages(space: np.ndarray, b: np.ndarray, step: int = STEP) -> np.ndarray:
    """Unit vectors of the passages that start every ``step`` words (one, if there are fewer than SPAN)."""
    if len(b) <= SPAN:
        v = space[b].sum(0, keepdims=True)
    else:
        sums = np.add.reduceat(space[b], np.arange(0, len(b), step), axis=0)
        k = SPAN // step
        n = max(1, len(sums) - k + 1)
        v = sum(sums[i : i + n] for i in range(k))
    norm = np.sqrt((v * v).sum(1, keepdims=True))
    return v / np.maximum(norm, 1e-12)


def answer_of(text: str) -> list[bytes]:
    """The words of the last sentence; of a single one, its last five."""
    parts = [p for p in re.split(r"[.?!\n]+(?:\s+|$)", text) if p.strip()]
    return words_of(parts[-1]) if len(parts) > 1 else words_of(text)[-5:]


#: Documents that are coded or searched at once, and bared at once.
TEXTS, ROWS = 1024, 256
#: Bytes that ``bare`` takes out of words.
MARKS = b".,;:!?\"'()[]{}|*#%&$"


def bare(words: list[bytes]) -> list[bytes]:
    """Words without punctuation, which would part copies; a word of nothing else becomes empty."""
    return b"\n".join(words).translate(None, MARKS).split(b"\n")


def holds(words: list[bytes], part: list[bytes]) -> bool:
    """Whether ``part`` stands in ``words`` in a row; words hold no line feed."""
    return not part or (bool(words) and b"\n%b\n" % b"\n".join(part) in b"\n%b\n" % b"\n".join(words))


#: Counts by item and place that are held at once.
AT_ONCE = 1 << 20


def spread(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers from each of ``lo`` on, so many as ``n`` says."""
    return np.arange(n.sum()) + np.repeat(lo - np.cumsum(n) + n, n)


class Index:
    """Which items can have ``PARAPHRASED`` of their words within a stretch of a text, told by hashes of bare words."""

    def __init__(self, items: list[list[bytes]]):
        words = [[w for w in item if w] for item in items]
        hashes = [hash_words(w) for w in words]
        self.known = distinct(np.concatenate([*hashes, np.zeros(0, np.uint64)]))
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.known & np.uint64(len(self.bits) - 1)).astype(np.int64)] = True
        ids = [np.searchsorted(self.known, h) for h in hashes]
        sets = [np.unique(i, return_counts=True) for i in ids]
        self.sets = [w for w, _ in sets]
        owner = np.repeat(np.arange(len(items)), [len(w) for w in self.sets])
        flat, times = (np.concatenate([*(s[j] for s in sets), np.zeros(0, np.int64)]).astype(np.int64) for j in (0, 1))
        order = np.argsort(flat, kind="stable")
        # of each word, the items that hold it and how many times
        self.holders, self.times, self.first = owner[order].astype(np.int32), times[order].astype(np.int32), np.searchsorted(flat[order], np.arange(len(self.known) + 1))
        # words that are nothing without their marks may be matched too, and aren't counted here
        self.need = np.array([PARAPHRASED * len(i) - sum(not w for w in i) - 1e-9 for i in items])
        self.reach = np.array([2 * len(i) + SPAN for i in items])

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word among the items' words, -1 for others."""
        out = np.full(len(hashes), -1)
        some = np.flatnonzero(self.bits[(hashes & np.uint64(len(self.bits) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.known, hashes[some]), max(len(self.known) - 1, 0))
        hit = self.known[at] == hashes[some]
        out[some[hit]] = at[hit]
        return out

    def before(self, i: int, ids: np.ndarray) -> np.ndarray:
        """How many of the words before each place are among those of item ``i``."""
        mine = np.zeros(len(self.known) + 1, bool)
        mine[self.sets[i]] = True
        return np.concatenate([[0], np.cumsum(mine[ids])])

    def possible(self, ids: np.ndarray) -> list[int]:
        """The items that a text of these words may hold: some stretch shares enough words with them, each counted as often as in both at most."""
        at = np.flatnonzero(ids >= 0)
        at = at[np.argsort(ids[at], kind="stable")]  # places by word
        words = ids[at]
        group = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]])) if len(at) else at
        here, sizes = words[group], np.diff(np.append(group, len(at)))
        lo, n = self.first[here], self.first[here + 1] - self.first[here]
        flat = spread(lo, n)
        holders, times, word = self.holders[flat], self.times[flat], np.repeat(np.arange(len(here)), n)
        enough = np.bincount(holders, np.minimum(times, sizes[word]), len(self.need)) >= self.need
        found = np.flatnonzero(enough)
        some = enough[holders]
        holders, times, word = holders[some], times[some], word[some]
        out = []
        step = max(1, AT_ONCE // (len(ids) + 1))
        for k in range(0, len(found), step):
            items = found[k : k + step]
            some = slice(None) if len(found) <= step else (holders >= items[0]) & (holders <= items[-1])
            g, c, n = word[some], times[some], sizes[word[some]]
            flat, start, back = spread(group[g], n), np.repeat(group[g], n), np.repeat(c, n)
            x, row = at[flat], np.repeat(np.searchsorted(items, holders[some]), n)
            # a place counts for the stretches that begin behind the place of this word so many times before
            last = np.where(flat - back >= start, at[np.maximum(flat - back, 0)], -1)
            begin = np.maximum(np.maximum(last, x - self.reach[items[row]]) + 1, 0)
            row *= len(ids) + 1
            size = len(items) * (len(ids) + 1)
            change = np.bincount(row + begin, minlength=size) - np.bincount(row + x + 1, minlength=size)
            most = np.cumsum(change).reshape(len(items), -1).max(1)  # each row's changes sum to nothing
            out.extend(items[most >= self.need[items]].tolist())
        return out


def bare_texts(texts: pa.Array) -> pa.Array:
    """The texts without the bytes that ``bare`` takes out."""
    texts = pa.concat_arrays([texts.fill_null("").cast(pa.large_string())])
    _, offsets, data = texts.buffers()
    if data is None or not len(texts):
        return texts
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    drop = np.zeros(256, bool)
    drop[[*MARKS]] = True
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    gone = drop[data]
    before = np.concatenate([[0], np.cumsum(gone)])
    offsets = offsets - offsets[0]
    return pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer((offsets - before[offsets]).tobytes()), pa.py_buffer(data[~gone].tobytes())])


def _search(space: np.ndarray, items: list[tuple[int, str]]):
    def make():
        tokens = Tokenizer()
        known = [(i, bare(words_of(t)), bare(answer_of(t)), t) for i, t in items]
        index, targets = Index([k[1] for k in known]), {}

        def of(i: int) -> tuple[np.ndarray, dict]:
            """The passages of an item, and its words' places; those asked for last are held."""
            if i not in targets:
                if len(targets) >= 1024:
                    del targets[next(iter(targets))]
                targets[i] = (passages(space, buckets_of(words_of(known[i][3])), 1).T.copy(), masks(known[i][1]))
            return targets[i]

        def match(i: int, v: np.ndarray, clean: list[bytes], numbers: np.ndarray) -> tuple[int, bool, int]:
            """``numbers``: of each word of ``clean`` among the items' words."""
            _, item, answer, _ = known[i]
            target, places = of(i)
            best = (0, False, 0)
            near = NEAR * min(1.0, len(item) / SPAN)
            empty = sum(not w for w in item)
            before = index.before(i, numbers)
            hits = [places.get(clean[h], 0) for h in np.flatnonzero(np.diff(before))]
            rows = max(64, (1 << 22) // target.shape[1])  # passages compared at once
            for lo in range(0, len(v), rows):
                at = STEP * (lo + np.flatnonzero((v[lo : lo + rows] @ target).max(1) >= np.float32(near)))
                # no more words in common than these
                begin, end = before[np.maximum(at - len(item), 0)], before[np.minimum(at + SPAN + len(item), len(clean))]
                for p, h, j in zip(at.tolist(), begin.tolist(), end.tolist(), strict=True):
                    if best[0] == len(item):
                        return best
                    if j - h + empty < max(best[0], PARAPHRASED * len(item) - 1e-9):
                        continue
                    around = clean[max(0, p - len(item)) : p + SPAN + len(item)]
                    n = aligned([places.get(w, 0) for w in around] if empty else hits[h:j], len(item))
                    if n >= best[0]:
                        best = max(best, (n, holds(around, answer), -p))
            return best

        def one(ids, texts):
            out = []
            wanted: dict[int, tuple[list[int], np.ndarray]] = {}
            for some in range(0, len(texts), ROWS):  # a part of the batch at a time, to hold less
                for block in tokens.blocks(bare_texts(texts.slice(some, ROWS))):
                    numbers = index.ids(block.hashes)
                    for at, (lo, hi) in enumerate(zip(block.bounds[:-1], block.bounds[1:], strict=True), some + block.first):
                        if found := index.possible(numbers[lo:hi]):
                            wanted[at] = (found, numbers[lo:hi])
            some = sorted(wanted)
            chosen = texts.take(pa.array(some, pa.int64())) if some else None
            for n_th, b in texts_of(tokens, chosen) if some else ():
                d, v, clean = ids[some[n_th]].as_py(), passages(space, b), bare(words_of(chosen[n_th].as_py()))
                found, told = wanted[some[n_th]]
                numbers = np.full(len(clean), -1)
                numbers[np.fromiter(map(bool, clean), bool, len(clean))] = told  # words that are nothing without their marks have none
                for i in found:
                    n, answered, p = match(i, v, clean, numbers)
                    size = len(known[i][1])
                    if n >= COPIED * size or (n >= PARAPHRASED * size and answered):
                        out.append((d, known[i][0], n, size, answered, -p))
            names = ("doc_id", "item_id", "lcs", "item_words", "answer", "near_word")
            return dict(zip(names, zip(*out, strict=True) if out else [()] * len(names), strict=True))

        return one

    return make


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id) of every document that holds an item: lcs, item_words, answer, near_word (a word near it)."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id IS NOT NULL")
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL")
    df, n = document_frequency(docs)
    weight = np.log((n + 1) / (df + 1.0)) + 0.01
    schema = "doc_id long, item_id long, lcs int, item_words int, answer boolean, near_word int"
    out = docs.sparkSession.createDataFrame([], schema)
    space, block = None, []

    def search(block):
        return map_batches(docs, schema, _search(space, block), TEXTS)

    for r in items.distinct().orderBy("item_id", "text").toLocalIterator():  # the stated query set, in blocks
        if not words_of(r.text):
            continue
        space = latent_space(docs, items, weight) if space is None else space
        block.append((r.item_id, r.text))
        if len(block) == ITEMS:
            out, block = out.unionByName(search(block)), []
    return (out.unionByName(search(block)) if block else out).distinct()
