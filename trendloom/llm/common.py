"""Helpers shared by the training-data operators: tables, stages, words, hashes."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from trendloom.session import checkpoint_root

#: A word of the contracts: a run without space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Spark's setting that removes the shuffle files of a query once it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage ends here, and the write's shuffle files go with it."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/llm-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: The tables that this driver has staged, in order.
STAGED: list[str] = []


def settle(df: DataFrame, name: str, since: int) -> DataFrame:
    """Stage ``df``, then delete all tables staged since STAGED had ``since`` entries: what ``df`` was made of."""
    out = stage(df, name)
    spark = df.sparkSession
    for old in STAGED[since:-1]:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(old)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    del STAGED[since:-1]
    return out


def discard(df: DataFrame) -> None:
    """Delete the table that ``stage`` wrote for ``df``, once all that is made of it is written too."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        if path.getName().startswith("llm-"):
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, bool]:
    """All columns by position (c0, c1, ...) with ``key``, and whether any id has texts that differ.

    The key names a document: it is the id, but where texts that differ share an
    id each of these gets a key of its own, from 2^62 on, by a hash of id and text. Rows of
    one id and text have one key; a null id has none.
    """
    at = {c: F.col(f"c{docs.columns.index(c)}") for c in (doc_id, text)}
    flat = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    plain = flat.withColumn("key", at[doc_id].cast("long"))
    h = F.xxhash64(at[text])
    several = plain.where("key IS NOT NULL").groupBy("key").agg(F.min(h).alias("lo"), F.max(h).alias("hi")).where("lo <> hi").select("key", F.lit(True).alias("parted"))
    if several.isEmpty():
        return plain, False
    own = F.xxhash64("key", at[text]).bitwiseAND((1 << 62) - 1).bitwiseOR(F.lit(1 << 62))
    joined = plain.join(several, "key", "left")
    return joined.select(*flat.columns, F.when(F.col("parted"), own).otherwise(F.col("key")).alias("key")), True


def slim(flat: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id (the key) and text of what ``keyed`` made of ``docs``."""
    return flat.select(F.col("key").alias("doc_id"), F.col(f"c{docs.columns.index(text)}").alias("text"))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lower-cased (``bytes.split`` cuts at exactly the characters of WORD)."""
    return text.encode().lower().split() if text else []


_LIBC = ctypes.CDLL(None)


def release() -> None:
    """Give back what this Python worker has freed: workers live as long as their executor, which shares its memory with them."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):  # of glibc only
        _LIBC.malloc_trim(0)


def tidied(run: Callable[[Iterable], Iterator]) -> Callable[[Iterable], Iterator]:
    """``run`` for a task's batches, and ``release`` once it has ended and holds nothing."""

    def whole(batches):
        yield from run(batches)
        release()

    return whole


def map_batches(df: DataFrame, schema: str, make: Callable[[], Callable[..., dict]], rows: int | None = None) -> DataFrame:
    """``make()`` once a task; the function it returns takes the columns of an Arrow batch (of ``rows`` rows at most, if given, to hold less), returns columns."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for b in (part for whole in batches for part in ([whole] if rows is None else (whole.slice(i, rows) for i in range(0, whole.num_rows, rows)))):
            out = fn(*b.columns)
            cols = [out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return df.mapInArrow(tidied(run), schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, elementwise over uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distinct(x: np.ndarray) -> np.ndarray:
    """The distinct values in order; by a sort, which is many times faster here than numpy's hashing unique."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: The inverse of MULTIPLIER modulo 2^64.
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes of text that are hashed at once (a longer document makes a block of its own).
BLOCK_BYTES = 1 << 20


class Block:
    """The words of some documents of a batch: hashes (64 bits of the lower-cased word), where each starts."""

    __slots__ = ("bounds", "edges", "first", "hashes", "lines", "starts")

    def __init__(self, first: int, hashes: np.ndarray, starts: np.ndarray, edges: np.ndarray, lines: np.ndarray):
        self.first, self.hashes, self.starts, self.edges, self.lines = first, hashes, starts, edges, lines
        #: document i of the block has words bounds[i] to bounds[i + 1]
        self.bounds = np.searchsorted(starts, edges)


class Tokenizer:
    """Hashes of all words of Arrow texts, without a Python object for each word.

    A word's hash is the polynomial of its bytes in MULTIPLIER modulo 2^64, read
    off prefix sums, then mixed; it depends on the word only.
    """

    def __init__(self):
        self.powers = self.inverses = np.ones(1, np.uint64)

    def blocks(self, texts: pa.Array) -> Iterator[Block]:
        if not len(texts):
            return
        texts = pa.concat_arrays([texts.fill_null("").cast(pa.large_string())])
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
        i = 0
        while i < len(texts):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK_BYTES, "right")) - 1)
            yield self.block(i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            i = j

    def block(self, first: int, data: np.ndarray, edges: np.ndarray) -> Block:
        n = len(data)
        if n > len(self.powers):
            size = max(n, min(2 * n, BLOCK_BYTES))
            self.powers, self.inverses = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, m, np.uint64)]), dtype=np.uint64) for m in (MULTIPLIER, INVERSE))
        if not n:
            none = np.zeros(0, np.int64)
            return Block(first, np.zeros(0, np.uint64), none, edges, none)
        b = _LOWER[data]
        space = _SPACE[b]
        before, after = np.empty(n, bool), np.empty(n, bool)
        before[1:], after[:-1] = space[:-1], space[1:]
        full = np.flatnonzero(edges[1:] > edges[:-1])
        before[edges[full]] = True
        after[edges[full + 1] - 1] = True
        word = ~space
        starts, stops = np.flatnonzero(word & before), np.flatnonzero(word & after) + 1
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self.powers[:n], out=sums[1:])
        hashes = mix64((sums[stops] - sums[starts]) * self.inverses[starts])
        return Block(first, hashes, starts, edges, np.flatnonzero(b == 10))


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words by position; fewer words make one shingle, none make none."""
    if not len(h):
        return h
    k = min(k, len(h))
    n = len(h) - k + 1
    out = mix64(h[:n] + np.uint64(k))
    for i in range(1, k):
        out = mix64(out * MULTIPLIER + h[i : i + n])
    return out


def hash_words(words: list[bytes]) -> np.ndarray:
    """The hashes that Tokenizer gives these words."""
    return next(Tokenizer().blocks(pa.array([b" ".join(words).decode()]))).hashes if words else np.zeros(0, np.uint64)


def sorted_groups(df: DataFrame, keys: list[str], order: list[str], schema: str, fn: Callable[[tuple, list], Iterable[dict]], partitions: int | None = None) -> DataFrame:
    """``fn(key, rows)`` for each group of the columns ``keys``, rows (as tuples) in ``order``.

    One shuffle and sort, then a pass over each sorted partition: no cost for
    each group as applyInPandas has. Only for groups that are bounded by a
    document, as one group's rows are held at a time.
    """
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    n = len(keys)
    names = keys + [c for c in df.columns if c not in keys]
    df = df.select(*names)
    dealt = df.repartition(partitions, *keys) if partitions else df.repartition(*keys)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, out = None, [], []

        def flush():
            cols = list(zip(*out, strict=True)) if out else [()] * len(arrow)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if row[:n] != key:
                    if rows:
                        out.extend(fn(key, rows))
                    key, rows = row[:n], []
                    if len(out) > 5000:
                        yield flush()
                        out = []
                rows.append(row[n:])
        if rows:
            out.extend(fn(key, rows))
        yield flush()

    return dealt.sortWithinPartitions(*keys, *order).mapInArrow(tidied(run), schema)


def byte_table(rows: DataFrame, value: str, bits: int, part_bits: int = 12) -> np.ndarray:
    """(bucket, value below 256) -> a byte for each of 2^bits buckets, gathered in parts of 2^part_bits bytes."""

    def fill(key, found):
        part = np.zeros(1 << part_bits, np.uint8)
        part[[f[0] for f in found]] = [f[1] for f in found]
        yield key[0], part.tobytes()

    rows = rows.select(F.shiftright("bucket", part_bits).alias("part"), F.col("bucket").bitwiseAND((1 << part_bits) - 1).alias("at"), F.col(value).cast("int").alias("v"))
    out = np.zeros(1 << bits, np.uint8)
    for r in sorted_groups(rows, ["part"], ["at"], "part int, bytes binary", fill).collect():
        out[r.part << part_bits : (r.part + 1) << part_bits] = np.frombuffer(r.bytes, np.uint8)
    return out


#: Buckets whose counts make one row, as a power of two, and such rows: places in the part (16 bits each) and their counts (32 bits each).
COUNT_BITS, COUNTS = 12, "part int, at binary, n binary"


def count_hashes(batches, hashes_of: Callable[[pa.RecordBatch], Iterable[np.ndarray]], bits: int) -> Iterator[pa.RecordBatch]:
    """A task's counts of hashes by bucket, as COUNTS: a row for each part of the buckets, not for each bucket."""
    held = np.zeros(1 << bits, np.int32)
    for b in batches:
        for h in hashes_of(b):
            at = np.sort((h & np.uint64(len(held) - 1)).astype(np.int64))  # sorted, so that the table is met in order
            first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else at
            held[at[first]] += np.diff(np.append(first, len(at))).astype(np.int32)
    parts = held.reshape(-1, 1 << COUNT_BITS)
    some = np.flatnonzero(parts.any(1))
    for i in range(0, len(some), 256):
        rows = [(int(p), np.flatnonzero(parts[p])) for p in some[i : i + 256]]
        part, at, n = ([p for p, _ in rows], [at.astype(np.uint16).tobytes() for _, at in rows], [parts[p, at].tobytes() for p, at in rows])
        yield pa.RecordBatch.from_pydict({"part": pa.array(part, pa.int32()), "at": pa.array(at, pa.binary()), "n": pa.array(n, pa.binary())})


def rarity_table(counts: DataFrame, bits: int) -> np.ndarray:
    """COUNTS of all tasks -> by bucket, 1 + the power of two of its count (0: none)."""

    def fill(key, found):
        sums = np.zeros(1 << COUNT_BITS, np.int64)
        for at, n in found:
            sums[np.frombuffer(at, np.uint16)] += np.frombuffer(n, np.int32)
        yield key[0], np.frexp(sums.astype(np.float64))[1].astype(np.uint8).tobytes()

    out = np.zeros(1 << bits, np.uint8)
    for r in sorted_groups(counts, ["part"], [], "part int, bytes binary", fill).collect():
        out[r.part << COUNT_BITS : (r.part + 1) << COUNT_BITS] = np.frombuffer(r.bytes, np.uint8)
    return out


#: Bits that a table which is sent to all tasks has at most, as a power of two.
MOST_BITS = 27


class BitTable:
    """A set of hashes as bits; may hold more than was put in, never less."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(len(bits) * 8 - 1)

    def holds(self, h: np.ndarray) -> np.ndarray:
        at = h & self.mask
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    @classmethod
    def of(cls, hashes: DataFrame, n: int, part_bits: int = 15) -> BitTable:
        """From the column ``h`` of ``n`` rows: 32 bits or more for each, gathered in parts of a bounded number and size."""
        bits = min(MOST_BITS, max(part_bits, (32 * n).bit_length()))

        def fill(key, rows):
            part = np.zeros(1 << part_bits, bool)
            part[[r[0] for r in rows]] = True
            yield key[0], np.packbits(part, bitorder="little").tobytes()

        at = F.col("h").bitwiseAND((1 << bits) - 1)
        rows = hashes.select(F.shiftright(at, part_bits).alias("part"), at.bitwiseAND((1 << part_bits) - 1).cast("int").alias("at")).distinct()
        out = np.zeros(1 << bits >> 3, np.uint8)
        width = 1 << part_bits >> 3
        for r in sorted_groups(rows, ["part"], ["at"], "part long, bytes binary", fill).collect():
            out[r.part * width : (r.part + 1) * width] = np.frombuffer(r.bytes, np.uint8)
        return cls(out)
