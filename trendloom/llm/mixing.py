"""Mixing sources to target weights by Sainte-Lague apportionment.

Sources are weighed by their rank in code point order (null last), share
``share`` times all words, and stop at ``cap`` times their own words, the excess
going to the others by weight. The mix is then cut into blocks of ``block``
words; sources get whole blocks by highest quotients target / (2 k + 1), the
shards of a source get its blocks in the same way, and a shard takes its quota
by whole passes and, for the rest, by a seeded permutation of its blocks.

Defined results: a null text or one without words has size 0 and takes 0; null
is a source of its own, the last; equal quotients go to the earlier source or
shard; rows that repeat are separate documents; an empty table gives no rows.
Only the id, text and source columns are read, so other columns never clash.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from trendloom.llm.common import WORD, stage

#: Words of a block, words of a shard (so that a shard's documents fit one task), and the seed.
BLOCK, SHARD_WORDS, SEED = 64, 1 << 16, "mix-1"
#: A multiplier for permuting blocks: a prime above any number of blocks in a shard.
PRIME = 2147483647
#: Divisors tried in a round of the search, and rounds; what they leave open is dealt one by one.
GRID, ROUNDS = 64, 3


def targets(sources: DataFrame, weights: tuple[int, ...], share: Fraction, cap: int) -> DataFrame:
    """(source, source_size) -> with target; water level found on one-row aggregates."""
    spark = sources.sparkSession
    schema = T.StructType([*sources.schema.fields, T.StructField("rank", T.LongType())])
    ranked = spark.createDataFrame(sources.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex().map(lambda x: (*x[0], x[1])), schema)
    ranked = stage(ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))), "mix-sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    goal, level, full = Fraction(total) * share, 0.0, -1
    limit = F.col("source_size") * cap
    while True:
        over = limit <= F.lit(level) * F.col("weight")
        held, w, n = ranked.agg(F.sum(F.when(over, limit)), F.sum(F.when(~over, F.col("weight"))), F.count_if(over)).first()
        if n == full or not w:
            break
        full, level = n, float((goal - (held or 0)) / w)
    return ranked.withColumn("target", F.least(limit.cast("double"), F.lit(level) * F.col("weight")))


def sainte_lague(entries: DataFrame, group: str | None, weight: str, cap: str, seats: str, order: list[str], name: str) -> DataFrame:
    """Adds ``quota``: the seats of each group dealt to its entries by highest weight / (2 k + 1).

    The divisor at which the rounded shares add up to the seats is searched on
    a grid, one aggregate a round; the few seats whose quotients fall inside the
    last bracket are dealt one by one in ``order``. No group meets in one task
    but for those few.
    """
    g = F.col(group) if group else F.lit(0)
    entries = entries.withColumn("_g", g)
    at = lambda d: F.least(F.col(cap), F.floor(F.col(weight) / d + F.lit(0.5)))
    n, m, w = F.count("*"), F.max(seats), F.sum(weight)
    # at _hi the rounded shares can't exceed the seats, at _lo they reach them (unless caps forbid it)
    high = F.when(m > n, F.least(w / (m - n / 2), F.max(weight) * 2 + 1)).otherwise(F.max(weight) * 2 + 1)
    bracket = stage(entries.groupBy("_g").agg(m.alias("_m"), (w / (m + n) / 4).alias("_lo"), high.alias("_hi")).where("_lo > 0"), f"{name}-b")
    for _ in range(ROUNDS):
        point = lambda i: F.col("_lo") * F.pow(F.col("_hi") / F.col("_lo"), i / F.lit(float(GRID)))
        tried = entries.select("_g", weight, cap).join(bracket, "_g").withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(GRID - 1))))
        sums = tried.groupBy("_g", "_i").agg(F.sum(at(point(F.col("_i")))).alias("_s"))
        last = sums.join(bracket, "_g").groupBy("_g", "_m", "_lo", "_hi").agg(F.coalesce(F.max(F.when(F.col("_s") > F.col("_m"), F.col("_i"))), F.lit(0)).alias("_i"))
        top = F.when(F.col("_i") == GRID - 1, F.col("_hi")).otherwise(point(F.col("_i") + 1))
        bracket = stage(last.select("_g", "_m", F.when(F.col("_i") == 0, F.col("_lo")).otherwise(point(F.col("_i"))).alias("_lo"), top.alias("_hi")), f"{name}-b")
    base = stage(entries.join(bracket.select("_g", "_lo", "_hi"), "_g", "left").withColumn("_q", F.coalesce(at(F.col("_hi")), F.lit(0)).cast("long")), f"{name}-q")
    left = base.groupBy("_g").agg((F.max(seats) - F.sum("_q")).alias("_left")).where("_left > 0")
    # seats whose quotient is inside the bracket: at most a few an entry, their number is the seats left
    inside = F.greatest(F.coalesce(at(F.col("_lo")), F.lit(0)).cast("long") - F.col("_q"), F.lit(0))
    more = base.where(inside > 0).withColumn("_k", F.explode(F.sequence(F.col("_q"), F.col("_q") + inside - 1)))
    w = Window.partitionBy("_g").orderBy((F.col(weight) / (2 * F.col("_k") + 1)).desc(), *order)
    more = more.join(left, "_g").withColumn("_r", F.row_number().over(w)).where("_r <= _left").groupBy("_g", *order).agg(F.count("*").alias("_more"))
    joined = base.alias("b").join(more.alias("m"), [F.col(f"b.{c}").eqNullSafe(F.col(f"m.{c}")) for c in ("_g", *order)], "left")
    return joined.select("b.*", (F.col("b._q") + F.coalesce(F.col("m._more"), F.lit(0))).alias("quota")).drop("_g", "_lo", "_hi", "_q")


def seeded(*cols: Column) -> Column:
    """A number below 2^32 from the md5 of the seed and columns (null: empty)."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(SEED), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])), 1, 8), 16, 10).cast("long")


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = (3, 1, 2), share: Fraction = Fraction(3, 2), cap: int = 2, block: int = BLOCK, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, shard, quota (its shard's blocks), taken."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    sizes = stage(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size.alias("size")), "mix-sizes")
    per_source = targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
    seats = per_source.agg(F.floor(F.sum("target") / block + 0.5).cast("long")).first()[0] or 0
    per_source = per_source.withColumn("cap", cap * F.ceil(F.col("source_size") / block)).withColumn("seats", F.lit(seats))
    per_source = stage(sainte_lague(per_source, None, "target", "cap", "seats", ["rank"], "mix-src").select("source", "rank", "source_size", "target", F.col("quota").alias("seats"), F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1)).cast("long").alias("shards")), "mix-src")

    s, p = sizes.alias("s"), per_source.alias("p")
    placed = s.join(p, F.col("s.source").eqNullSafe(F.col("p.source"))).select("s.*", "p.rank", "p.source_size", "p.target", "p.seats", F.pmod(seeded(F.lit("shard"), F.col("doc_id")), F.col("p.shards")).alias("shard"))
    shards = placed.groupBy("rank", "shard").agg(F.sum("size").cast("double").alias("words"), F.max("seats").alias("seats"))
    shards = shards.withColumn("blocks", F.ceil(F.col("words") / block)).withColumn("cap", cap * F.col("blocks"))
    quotas = stage(sainte_lague(shards, "rank", "words", "cap", "seats", ["rank", "shard"], "mix-shd").select("rank", "shard", "blocks", "quota"), "mix-quota")

    line = Window.partitionBy("rank", "shard").orderBy(seeded(F.lit("place"), F.col("doc_id")), F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    laid = placed.withColumn("stop", F.sum("size").over(line)).withColumn("start", F.col("stop") - F.col("size"))
    laid = laid.join(quotas, ["rank", "shard"])
    n, rest = F.col("blocks"), F.col("quota") % F.greatest(F.col("blocks"), F.lit(1))
    chosen = lambda b: (F.pmod(b * PRIME + seeded(F.lit("blocks"), F.col("rank"), F.col("shard")), n)) < rest
    part = lambda b: F.least(F.col("stop"), (b + 1) * block) - F.greatest(F.col("start"), b * block)
    spans = F.sequence(F.floor(F.col("start") / block), F.floor((F.col("stop") - 1) / block))
    some = F.aggregate(spans, F.lit(0).cast("long"), lambda acc, b: acc + F.when(chosen(b), part(b)).otherwise(0))
    taken = F.when(F.col("size") == 0, F.lit(0)).otherwise(F.floor(F.col("quota") / F.greatest(n, F.lit(1))) * F.col("size") + some)
    return laid.select("doc_id", "source", "size", "source_size", "target", "shard", "quota", taken.cast("long").alias("taken"))
