"""URL filter: rules first, then the ratio of two character language models.

Rules name a host (it fits subdomains too) and a path prefix; the longest rule
that fits decides. URLs that no rule fits are judged by two variable-order
Markov models over characters, one of the URLs that rules allow, one of those
they block. A model's estimate for a character after a context of k characters
interpolates counts with the estimate for the context one shorter by
Witten-Bell smoothing; contexts never seen pass the shorter one's on, so the
order varies with what was seen. A URL's score is the difference of the models'
log-likelihoods for a character; the threshold is the one that best tells
allowed from blocked URLs in the fifth of them that the models don't learn from.

All of it is DataFrame operations. Counts come from all labelled URLs; windows
of characters are scored once each, then joined to the URLs and summed as whole
millionths, so the sums don't depend on the order.

Defined results: a URL that is null or has no ``://`` has an empty host and path
(it is then judged as a whole; null or empty scores 0); where the rules leave
one kind without URLs, the threshold is 0; equal scores share a verdict, the
threshold itself allows; rows that repeat are judged alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trendloom.llm.common import LOWER, UPPER, lower_ascii, stage

#: Longest context, characters a model without counts assumes, and what stands before a URL.
ORDER, ALPHABET, PAD = 4, 256, "\n"
#: Scores a hundredth apart share a bin of the calibration, at most so many bins either side of 0.
BINS = 2000
#: Of five parts of the labelled URLs, the one kept for the calibration.
FOLDS = 5

RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def by_rules(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest rule that fits, and its action; both null if none does."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, a in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):  # the longest ends up outermost
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, action = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(a)).otherwise(action)
    return rule, action


def fold_of(c: Column) -> Column:
    return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("long") % FOLDS


def windows(rows: DataFrame) -> DataFrame:
    """A row for each character: with the ORDER characters before it."""
    chars = F.split(F.concat(F.lit(PAD * ORDER), F.col("tail")), "")
    rows = rows.where("tail <> ''").withColumn("chars", chars)
    each = F.transform(F.sequence(F.lit(1), F.size("chars") - ORDER), lambda i: F.array_join(F.slice("chars", i, ORDER + 1), ""))
    return rows.withColumn("g", F.explode(each)).drop("chars")


def scored_windows(grams: DataFrame) -> DataFrame:
    """(g, allow, block) counts -> (g, score): the millionths of the log-ratio."""
    by_order = grams.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(ORDER)))).withColumn("ctx", F.expr(f"substring(g, {ORDER + 1} - k, k)")).withColumn("ch", F.substring("g", ORDER + 1, 1))
    counts = stage(by_order.groupBy("ctx", "ch").agg(F.sum("allow").alias("a"), F.sum("block").alias("b")), "url-counts")
    totals = stage(counts.groupBy("ctx").agg(F.sum("a").alias("na"), F.sum("b").alias("nb"), F.count_if(F.col("a") > 0).alias("ta"), F.count_if(F.col("b") > 0).alias("tb")), "url-totals")
    joined = by_order.select("g", "k", "ctx", "ch").join(counts, ["ctx", "ch"]).join(totals, "ctx")
    levels = joined.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("k", "a", "na", "ta", "b", "nb", "tb"))).alias("levels"))  # ORDER + 1 of them

    def model(n: str, total: str, kinds: str) -> Column:
        return F.aggregate("levels", F.lit(1.0 / ALPHABET), lambda p, x: F.when(x[total] > 0, (x[n] + x[kinds] * p) / (x[total] + x[kinds])).otherwise(p))

    ratio = F.log(model("a", "na", "ta")) - F.log(model("b", "nb", "tb"))
    return levels.select("g", F.floor(ratio * 1e6 + 0.5).cast("long").alias("score"))


def threshold(scores: DataFrame) -> DataFrame:
    """(label, n, score) -> one row: the bin edge with the best balanced accuracy, nearest to 0 of equals."""
    at = F.greatest(F.least(F.floor(F.col("score") * 100), F.lit(BINS)), F.lit(-BINS)).cast("int")
    bins = scores.groupBy(at.alias("at")).agg(F.sum(F.when(F.col("label") == "allow", F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("label") == "block", F.col("n")).otherwise(0)).alias("b"))
    whole, below = Window.partitionBy(F.lit(0)), Window.partitionBy(F.lit(0)).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)  # at most 2 BINS + 1 rows
    sums = bins.select("at", F.sum("a").over(whole).alias("all_a"), F.sum("b").over(whole).alias("all_b"), F.coalesce(F.sum("a").over(below), F.lit(0)).alias("lost"), F.coalesce(F.sum("b").over(below), F.lit(0)).alias("caught"))
    gain = (F.col("caught") * F.col("all_a") - F.col("lost") * F.col("all_b")).cast("decimal(38,0)")
    best = sums.where("all_a > 0 AND all_b > 0").agg(F.min_by("at", F.struct(-gain, F.abs("at"), "at")).alias("at"))
    return best.select(F.coalesce(F.col("at") / 100.0, F.lit(0.0)).alias("threshold"))


def judge_urls(pages: DataFrame, rules=RULES, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict."""
    u = F.coalesce(F.col(url), F.lit(""))
    base = pages.select(F.col(page_id).alias("page_id"), u.alias("u"))
    base = base.withColumn("host", F.coalesce(lower_ascii(F.regexp_extract("u", PARTS, 1)), F.lit(""))).withColumn("path", F.coalesce(F.regexp_extract("u", PARTS, 2), F.lit("")))
    rule, action = by_rules(F.col("host"), F.col("path"), rules)
    tail = F.when(F.instr("u", "://") > 0, F.expr("substring(u, instr(u, '://') + 3)")).otherwise(F.col("u"))
    base = base.select("page_id", "host", "path", rule.alias("rule"), action.alias("label"), tail.alias("tail"))

    tails = base.groupBy("tail", "label").agg(F.count("*").alias("n"))
    tails = stage(tails.withColumn("row", F.monotonically_increasing_id()).withColumn("learn", fold_of(F.col("tail")) != 0), "url-tails")
    of = lambda a: F.sum(F.when(F.col("learn") & (F.col("label") == a), F.col("n")).otherwise(0))
    grams = stage(windows(tails).groupBy("g").agg(of("allow").alias("allow"), of("block").alias("block")), "url-grams")
    ratio = stage(scored_windows(grams), "url-windows")
    sums = windows(tails.select("row", "tail")).select("row", "g").join(ratio, "g").groupBy("row").agg((F.sum("score") / F.count("*") / 1e6).alias("score"))
    scores = stage(tails.join(sums, "row", "left").select("tail", "label", "n", "learn", F.coalesce("score", F.lit(0.0)).alias("score")), "url-scores")
    at = threshold(scores.where("NOT learn AND label IS NOT NULL")).first()[0]
    verdict = scores.select("tail", "label", F.coalesce("label", F.when(F.col("score") >= at, "allow").otherwise("block")).alias("verdict"))
    b, v = base.alias("b"), verdict.alias("v")
    return b.join(v, (F.col("b.tail") == F.col("v.tail")) & F.col("b.label").eqNullSafe(F.col("v.label"))).select("page_id", "host", "path", "rule", "verdict")


def oracle(rules=RULES) -> str:
    """The same in DuckDB SQL."""
    cases = lambda what: " ".join(f"WHEN (host = '{r[0]}' OR host LIKE '%.{r[0]}') AND starts_with(path, '{r[1]}') THEN '{what(r)}'" for r in sorted(rules, key=lambda r: (len(r[0] + r[1]), r), reverse=True))
    cols = ", ".join(f"max(CASE WHEN k = {k} THEN {c} END)::DOUBLE AS {c}{k}" for k in range(ORDER + 1) for c in ("a", "na", "ta", "b", "nb", "tb"))
    steps, prev = [], "lv"
    for k in range(ORDER + 1):
        pa, pb = ("pa", "pb") if k else (f"1.0::DOUBLE / {ALPHABET}",) * 2
        grow = lambda n, p, k=k: f"CASE WHEN n{n}{k} > 0 THEN ({n}{k} + t{n}{k} * ({p})) / (n{n}{k} + t{n}{k}) ELSE {p} END AS p{n}"
        steps.append(f"p{k} AS (SELECT {'* EXCLUDE (pa, pb)' if k else '*'}, {grow('a', pa)}, {grow('b', pb)} FROM {prev})")
        prev = f"p{k}"
    return f"""
WITH u AS (SELECT page_id, coalesce(url, '') AS u FROM pages),
h AS (SELECT page_id, u, translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
        regexp_extract(u, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path,
        CASE WHEN instr(u, '://') > 0 THEN substr(u, instr(u, '://') + 3) ELSE u END AS tail FROM u),
base AS (SELECT page_id, host, path, tail, CASE {cases(lambda r: r[0] + r[1])} END AS rule, CASE {cases(lambda r: r[2])} END AS label FROM h),
tails AS (SELECT tail, label, count(*) AS n, ('0x' || substr(md5(tail), 1, 8))::BIGINT % {FOLDS} <> 0 AS learn FROM base GROUP BY tail, label),
win AS (SELECT tail, label, n, learn, substr(repeat(chr(10), {ORDER}) || tail, i::BIGINT, {ORDER + 1}) AS g
        FROM (SELECT *, unnest(range(1, length(tail) + 1)) AS i FROM tails WHERE tail <> '')),
grams AS (SELECT g, sum(CASE WHEN learn AND label = 'allow' THEN n ELSE 0 END) AS allow, sum(CASE WHEN learn AND label = 'block' THEN n ELSE 0 END) AS block FROM win GROUP BY g),
ord AS (SELECT g, allow, block, k, substr(g, {ORDER + 1} - k::BIGINT, k::BIGINT) AS ctx, substr(g, {ORDER + 1}, 1) AS ch FROM (SELECT *, unnest(range(0, {ORDER + 1})) AS k FROM grams)),
cnt AS (SELECT k, ctx, ch, sum(allow) AS a, sum(block) AS b FROM ord GROUP BY k, ctx, ch),
tot AS (SELECT k, ctx, sum(a) AS na, sum(b) AS nb, count(*) FILTER (a > 0) AS ta, count(*) FILTER (b > 0) AS tb FROM cnt GROUP BY k, ctx),
lv AS (SELECT g, {cols} FROM ord JOIN cnt USING (k, ctx, ch) JOIN tot USING (k, ctx) GROUP BY g),
{", ".join(steps)},
ratio AS (SELECT g, floor((ln(pa) - ln(pb)) * 1e6 + 0.5)::BIGINT AS score FROM {prev}),
sums AS (SELECT tail, label, sum(score)::DOUBLE / count(*) / 1e6 AS score FROM win JOIN ratio USING (g) GROUP BY tail, label),
sc AS (SELECT t.tail, t.label, t.n, t.learn, coalesce(s.score, 0.0) AS score FROM tails t LEFT JOIN sums s ON t.tail = s.tail AND t.label IS NOT DISTINCT FROM s.label),
bins AS (SELECT greatest(least(floor(score * 100), {BINS}), -{BINS})::INTEGER AS edge_at, sum(CASE WHEN label = 'allow' THEN n ELSE 0 END) AS a, sum(CASE WHEN label = 'block' THEN n ELSE 0 END) AS b
         FROM sc WHERE NOT learn AND label IS NOT NULL GROUP BY 1),
edge AS (SELECT edge_at, sum(a) OVER () AS all_a, sum(b) OVER () AS all_b,
           coalesce(sum(a) OVER (ORDER BY edge_at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lost,
           coalesce(sum(b) OVER (ORDER BY edge_at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caught FROM bins),
th AS (SELECT coalesce((SELECT edge_at / 100.0::DOUBLE FROM edge WHERE all_a > 0 AND all_b > 0 ORDER BY caught * all_a - lost * all_b DESC, abs(edge_at), edge_at LIMIT 1), 0.0) AS t)
SELECT b.page_id, b.host, b.path, b.rule, coalesce(b.label, CASE WHEN s.score >= (SELECT t FROM th) THEN 'allow' ELSE 'block' END) AS verdict
FROM base b JOIN sc s ON b.tail = s.tail AND b.label IS NOT DISTINCT FROM s.label
"""
