"""Language ID by a blended-spectrum presence kernel, Nystroem landmarks and kernel ridge regression.

A text is the set of its n-grams of 1 to 3 bytes (UTF-8, lower case), hashed to
a fixed number of buckets. k(x, y) = |x & y| / sqrt(|x| |y|). One ridge
regression a language (against the rest) is fitted in the space of the
landmarks' kernel values, on at most ``sample`` labelled texts, evenly by
language. As the kernel is linear in the presence vector of x, landmarks and
coefficients fold into one matrix of buckets by languages, and texts are scored
by products of presence matrices with it.

Defined results: a text that is null or without a letter gets ``und`` and score
0, as does every text when nothing can be learned; equal scores go to the
language first in order; a null id counts as empty (held out); repeated rows
are judged one by one; very long texts are read piece by piece, wholly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm.common import map_batches

#: Buckets of n-grams by length (powers of two; single bytes have their own), and bits of each.
BITS = {1: 8, 2: 12, 3: 13}
WIDTH = sum(1 << b for b in BITS.values())
#: Bounds of the fit: labelled texts and landmarks, both over all languages; the ridge.
SAMPLE, LANDMARKS, RIDGE = 4096, 256, 1e-2
#: Bytes that are hashed at once, and texts of a presence matrix.
PIECE, BATCH = 1 << 20, 128
#: Sharpness of the scores' soft maximum.
SHARP = 4.0
#: Score below which a filter takes a text for no language: hardly above an even choice among four.
LEAST_SCORE = 0.3


def presence(texts: list[str]) -> np.ndarray:
    """Rows of 0 and 1: which buckets a text's n-grams fall into."""
    flags = np.zeros((len(texts), WIDTH), np.uint8)
    flat = flags.reshape(-1)
    held: list[tuple[int, bytes]] = []

    def mark() -> None:
        data = np.frombuffer(b"".join(p for _, p in held), np.uint8).astype(np.uint32)
        sizes = np.array([len(p) for _, p in held])
        row = np.repeat(np.array([i for i, _ in held], np.int64) * WIDTH, sizes)
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))  # bytes to the piece's end
        code, offset = np.zeros_like(data), 0
        for n, bits in BITS.items():
            code = (code[: len(data) - n + 1] << np.uint32(8)) | data[n - 1 :]
            fits = left[: len(code)] >= n
            bucket = code if n == 1 else (code * np.uint32(2654435761)) >> np.uint32(32 - bits)
            flat[(row[: len(code)] + (bucket.astype(np.int64) + offset))[fits]] = 1
            offset += 1 << bits
        held.clear()

    size = 0
    for i, text in enumerate(texts):
        data = text.lower().encode()
        for at in range(0, len(data), PIECE):
            piece = data[at : at + PIECE + max(BITS) - 1]
            held.append((i, piece))
            size += len(piece)
            if size >= PIECE:
                mark()
                size = 0
    if held:
        mark()
    return flags


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def held_out(doc_id) -> F.Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, doc_id: str, text: str, lang: str, sample: int = SAMPLE, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> tuple[list[str], np.ndarray]:
    """The languages in order and the matrix of buckets by languages."""
    rows = docs.where(~held_out(doc_id) & F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(doc_id), F.lit("sample")).alias("key"))
    rows = rows.where(F.col("text").rlike(r"\p{L}"))
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(counts)
    if not langs:
        return [], np.zeros((WIDTH, 0), np.float32)
    share = max(1, sample // len(langs))
    part = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, share / counts[k]))])
    rows = rows.where(F.pmod("key", F.lit(1 << 20)) < part[F.col("lang")] * F.lit(1 << 20)).limit(2 * sample)

    def bits():
        return lambda lang, text, key: {"lang": lang, "key": key, "bits": [np.packbits(x).tobytes() for x in presence(text.to_pylist())]}

    found = sorted(map_batches(rows, "lang string, key long, bits binary", bits).collect(), key=lambda r: (r.key, r.lang, r.bits))
    unpack = lambda rs: np.unpackbits(np.frombuffer(b"".join(r.bits for r in rs), np.uint8).reshape(len(rs), -1), axis=1)
    each = max(1, landmarks // len(langs))
    marks = unpack([r for k in langs for r in [x for x in found if x.lang == k][:each]]).astype(np.float32)
    marks /= np.sqrt(marks.sum(1, keepdims=True))
    kmm = (marks @ marks.T).astype(np.float64)
    values, vectors = np.linalg.eigh(kmm)
    keep = values > 1e-8 * values[-1]
    root = vectors[:, keep] / np.sqrt(values[keep])
    gram, right = np.zeros((root.shape[1],) * 2), np.zeros((root.shape[1], len(langs)))
    for at in range(0, len(found), 256):
        some = found[at : at + 256]
        x = unpack(some).astype(np.float32)
        phi = (x @ marks.T / np.sqrt(x.sum(1, keepdims=True))).astype(np.float64) @ root
        y = np.array([[1.0 if r.lang == k else -1.0 for k in langs] for r in some])
        gram += phi.T @ phi
        right += phi.T @ y
    coef = root @ np.linalg.solve(gram + ridge * len(found) / len(langs) * np.eye(len(gram)), right)
    return langs, (marks.T.astype(np.float64) @ coef).astype(np.float32)


def judge(langs: list[str], matrix: np.ndarray):
    """texts -> (languages, scores)."""

    def texts_of(texts: list[str | None]) -> tuple[list[str], list[float]]:
        pred, score = ["und"] * len(texts), [0.0] * len(texts)
        known = [i for i, t in enumerate(texts) if langs and has_letter(t)]
        for at in range(0, len(known), BATCH):
            some = known[at : at + BATCH]
            x = presence([texts[i] for i in some]).astype(np.float32)
            s = np.round((x @ matrix).astype(np.float64) / np.sqrt(x.sum(1, dtype=np.float64))[:, None], 5)
            p = np.exp(SHARP * (s - s.max(1, keepdims=True)))
            p /= p.sum(1, keepdims=True)
            for i, k, v in zip(some, s.argmax(1), p.max(1), strict=True):
                pred[i], score[i] = langs[k], round(float(v), 4)
        return pred, score

    return texts_of


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", **bounds) -> DataFrame:
    """doc_id, held_out, lang_pred and score (0 to 1); learned from the rows that are not held out."""
    langs, matrix = fit(docs, doc_id, text, lang, **bounds)

    def make():
        of = judge(langs, matrix)

        def one(ids, out, texts):
            pred, score = of(texts.to_pylist())
            return {"doc_id": ids, "held_out": out, "lang_pred": pred, "score": score}

        return one

    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).alias("text"))
    return map_batches(rows, "doc_id long, held_out boolean, lang_pred string, score double", make)


def keep_identified(docs: DataFrame, least: float = LEAST_SCORE, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", **bounds) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language with a score of at least ``least``."""
    langs, matrix = fit(docs, doc_id, text, lang, **bounds)

    def run(batches):
        of = judge(langs, matrix)
        for b in batches:
            pred, score = of(b.column(b.schema.get_field_index(text)).to_pylist())
            yield b.filter(pa.array([p != "und" and s >= least for p, s in zip(pred, score, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
