"""Exact top-k by inner product: a Voronoi join.

Vectors belong to the cell of their nearest pivot, and to a ring of it by their
distance from the pivot; the number of pivots grows with the root of the rows. A
ring's summary holds its greatest distance, its range of norms and its greatest
angle to the pivot. For a query these bound the products in a ring twice: by
q.p + |q| |x - p|, and by the norms and the least angle that is left between q
and x. Rings whose bound is below the query's k-th best score among a bounded
reference sample hold none of its best. The queries of a
cell form a group, neighbouring cells a common one where they need much the same
rings; a group is sent the rings that some query of it needs, in as many bins
as these fill, and is itself copied to those bins only. Bins are solved locally,
and their best meet for each query.

Where vectors have no neighbourhoods (as at random in many dimensions) no bound
can prune, and all is compared, in blocks; ``evaluated`` tells the share.

Defined results: a row whose vector or id is null, or that holds a null or
non-finite component, takes no part; shorter vectors count as padded by zeros;
rows that repeat an id are all the query's own; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trendloom.llm.common import map_batches, stage

#: Least and most pivots, rings of a cell and reference rows (bounds of the summaries), queries of a group, vectors of a bin.
FEW, PIVOTS, RINGS, REFERENCE, GROUP, BIN = 16, 1024, 6, 2048, 512, 2048
#: Cells share a group if it is sent at most so much more than the one of them that is sent most.
MORE = 1.25


def _matrix(vectors: list[bytes], dim: int) -> np.ndarray:
    """Rows of int64 vectors, padded by zeros."""
    if all(len(v) == 8 * dim for v in vectors):
        return np.frombuffer(b"".join(vectors), np.int64).reshape(len(vectors), dim)
    out = np.zeros((len(vectors), dim), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v) // 8] = np.frombuffer(v, np.int64)
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: by floats where these are exact, else by integers."""
    most = lambda x: float(np.abs(x).max(initial=0))
    if most(a) * most(b) * max(a.shape[1], 1) < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


class Join:
    """Groups of queries (``asks``: grp, vec_id, vec), the vectors sent to them (``sent``: grp, vec_id, vec), and their numbers."""

    def __init__(self, asks: DataFrame, sent: DataFrame, dim: int, rows: int, queries: int):
        self.asks, self.sent, self.dim, self.rows, self.queries = asks, sent, dim, rows, queries

    def evaluated(self) -> float:
        """The share of all pairs of a query and a vector that is compared."""
        pairs = self.asks.groupBy("grp").count().join(self.sent.groupBy("grp").agg(F.count("*").alias("n")), "grp")
        return float(pairs.agg(F.coalesce(F.sum(F.col("count") * F.col("n")), F.lit(0))).first()[0]) / max(1, self.rows * self.queries)


def prepare(vectors: DataFrame, k: int = 5, every: int = 50, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256) -> Join | None:
    """The summaries, and who is sent where; None without rows."""
    e = F.col(embedding)
    whole = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.col(vec_id).isNotNull() & e.isNotNull()).where(whole)
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(e, lambda x: F.floor(x.cast("double") * scale)).alias("v"))

    def pack():
        def one(ids, v):
            flat, at = v.values.to_numpy(zero_copy_only=False).astype(np.int64), v.offsets.to_numpy()
            return {"vec_id": ids, "dim": np.diff(at), "vec": [flat[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]}

        return one

    rows = stage(map_batches(rows, "vec_id long, dim int, vec binary", pack), "knn-rows")
    n, queries, dim = rows.agg(F.count("*"), F.count_if(F.col("vec_id") % every == 0), F.coalesce(F.max("dim"), F.lit(0))).first()
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit("pivot")), "vec_id").limit(REFERENCE).collect()
    reference, reference_ids = _matrix([r.vec for r in sample], dim), np.array([r.vec_id for r in sample], np.int64)
    if not n:
        return None
    pivots = reference[: min(PIVOTS, max(FEW, 4 * math.isqrt(n)))].astype(np.float64)
    size = lambda x: np.sqrt((x**2).sum(1))
    pivot_size = size(pivots)

    def nearest(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d2 = (x**2).sum(1)[:, None] - 2 * x @ pivots.T + (pivots**2).sum(1)
        cell = d2.argmin(1)
        return cell, size(x - pivots[cell])

    width = max(float(nearest(reference.astype(np.float64))[1].max(initial=0.0)), 1e-9) / RINGS

    # neighbouring pivots' queries share a group: pivots in the order of a walk to the nearest unvisited one
    walk, left = [], set(range(len(pivots)))
    while left:
        at = min(left, key=lambda c: float(((pivots[c] - pivots[walk[-1]]) ** 2).sum())) if walk else min(left)
        walk.append(at)
        left.remove(at)

    def cells():
        def one(ids, vec):
            x = _matrix(vec.to_pylist(), dim).astype(np.float64)
            cell, far = nearest(x)
            norm = size(x)
            with np.errstate(divide="ignore", invalid="ignore"):
                angle = np.arccos(np.clip((x * pivots[cell]).sum(1) / (norm * pivot_size[cell]), -1, 1))
            ring = np.minimum(far / width, RINGS - 1).astype(np.int32)
            return {"vec_id": ids, "vec": vec, "cell": cell.astype(np.int32), "ring": cell.astype(np.int32) * RINGS + ring, "far": far, "norm": norm, "angle": np.where(np.isnan(angle), np.pi, angle)}

        return one

    placed = stage(map_batches(rows.select("vec_id", "vec"), "vec_id long, vec binary, cell int, ring int, far double, norm double, angle double", cells), "knn-cells")
    summary = placed.groupBy("ring").agg(F.max("far"), F.min("norm"), F.max("norm"), F.max("angle"), F.count("*")).orderBy("ring").collect()
    ring_of, far, least, most, angle, held = (np.array([r[i] for r in summary]) for i in range(6))
    asks = placed.where(F.col("vec_id") % every == 0)

    def bounds():
        def one(ids, vec, at):
            q = _matrix(vec.to_pylist(), dim)
            own = ids.to_numpy()[:, None] == reference_ids  # the sample may hold rows of the query's id
            scores = np.where(own, np.iinfo(np.int64).min, products(q, reference))
            kth = np.sort(scores, axis=1)[:, -k].astype(np.float64) if len(reference) >= k else np.full(len(q), -np.inf)
            kth[(~own).sum(1) < k] = -np.inf
            f = q.astype(np.float64)
            own_size, cell = size(f)[:, None], ring_of // RINGS
            dots = f @ pivots.T
            with np.errstate(divide="ignore", invalid="ignore"):
                apart = np.arccos(np.clip(dots / (own_size * pivot_size), -1, 1))
            apart = np.where(np.isnan(apart), 0.0, apart)[:, cell]
            turn = np.cos(np.maximum(0.0, apart - angle - 1e-6))
            bound = np.minimum(dots[:, cell] + own_size * far, own_size * np.where(turn > 0, most, least) * turn)
            need = bound + 1e-9 * np.abs(bound) + 1e-3 >= kth[:, None]
            out = {"cell": [], "ring": []}
            for c in np.unique(at.to_numpy()):
                some = ring_of[need[at.to_numpy() == c].any(0)]
                out["cell"].append(np.full(len(some), c))
                out["ring"].append(some)
            return {c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in out.items()}

        return one

    needs = stage(map_batches(asks.select("vec_id", "vec", "cell"), "cell int, ring int", bounds).distinct(), "knn-needs")
    number = {r[0]: r[1] for r in asks.groupBy("cell").count().collect()}
    rings = {r[0]: np.isin(ring_of, r[1]) for r in needs.groupBy("cell").agg(F.collect_set("ring")).collect()}
    # (cell, first group, groups): a cell of many queries is split, cells that need the same share a group
    groups, last, largest, room, union = [], -1, 0, 0, None
    for c in (c for c in walk if c in number):
        q, mine = number[c], rings.get(c, np.zeros(len(ring_of), bool))
        both = mine if union is None else union | mine
        if q <= room and held[both].sum() <= MORE * max(largest, held[mine].sum()):
            union, room, largest = both, room - q, max(largest, held[mine].sum())
        else:
            last, union, room, largest = last + 1, mine, GROUP - q, held[mine].sum()
        parts = -(-q // GROUP)
        groups.append((c, last, parts))
        last, room = last + parts - 1, room if parts == 1 else 0
    of = vectors.sparkSession.createDataFrame(groups, "cell int, first int, parts int")
    asks = asks.join(F.broadcast(of), "cell").select((F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("parts"))).cast("int").alias("grp"), "vec_id", "vec")
    wanted = needs.join(F.broadcast(of), "cell").select("ring", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("parts") - 1)).alias("grp")).distinct()
    sent = placed.join(wanted, "ring").select("grp", "vec_id", "vec")
    return Join(stage(asks.select("grp", "vec_id", "vec"), "knn-asks"), stage(sent, "knn-sent"), dim, n, queries)


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: for each id divisible by ``every``, the ``k`` best others, ties to the smaller id."""
    join = prepare(vectors, k, every, vec_id, embedding, scale)
    if join is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dim = join.dim
    fill = join.sent.groupBy("grp").agg(F.ceil(F.count("*") / BIN).cast("int").alias("bins"))
    sent = join.sent.join(fill, "grp").select("grp", F.pmod(F.xxhash64("vec_id", F.lit("bin")), F.col("bins")).cast("int").alias("bin"), "vec_id", "vec")
    asked = join.asks.join(fill, "grp").select("grp", F.explode(F.sequence(F.lit(0), F.col("bins") - 1)).alias("bin"), F.col("vec_id").alias("query_id"), F.col("vec").alias("query"))

    def solve(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values("vec_id", kind="stable")
        ids, own = x["vec_id"].to_numpy(np.int64), q["query_id"].to_numpy(np.int64)
        s = products(_matrix(q["query"].tolist(), dim), _matrix(x["vec"].tolist(), dim)) if len(q) and len(x) else np.zeros((len(q), len(x)), np.int64)
        order = np.argsort(-s, axis=1, kind="stable")
        found = []
        for i, me in enumerate(own):
            mine = order[i][ids[order[i]] != me][:k]
            found.append((np.full(len(mine), me), ids[mine], s[i][mine]))
        cols = [np.concatenate([f[j] for f in found]) if found else np.zeros(0, np.int64) for j in range(3)]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), cols, strict=True)))

    best = asked.groupBy("grp", "bin").cogroup(sent.toDF("grp", "bin", "vec_id", "vec").groupBy("grp", "bin")).applyInPandas(solve, "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
      FROM v q JOIN v d ON d.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
WHERE rank <= 5
"""
