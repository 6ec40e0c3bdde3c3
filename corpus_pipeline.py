"""The corpus pipeline: documents through five operators to a mix of sources.

Each stage takes (spark, docs, sf_dir) and works on all that the one before
kept; all but the last return the columns of documents. Documents without an id
are never linked or matched, so only the language stage can drop them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.llm import decontaminate, langid, lines, minhash, mixing
from trendloom.llm.common import STAGED, keyed, settle, slim, stage, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language that can be told; those without a letter, or of no language, go."""
    return langid.keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line is similar to; n_chars follows the text."""
    out = lines.drop_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def named(flat: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from what ``keyed`` made of them."""
    return flat.select(*[f"c{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, Jaccard 0.8) the document of the smallest id, once if rows repeat its id and text.

    Texts that differ are different documents, also if they share an id.
    """
    flat, _ = keyed(docs)
    found = minhash.near_duplicates(slim(flat, docs), k=5, percent=80)
    kept = flat.join(found.where("NOT kept").select(F.col("doc_id").alias("key")).distinct(), "key", "left_anti")
    repeated = stage(flat.where("key IS NOT NULL").groupBy("key").count().where("count > 1").select("key"), "pipeline-repeated")
    if not repeated.isEmpty():
        kept = kept.join(repeated, "key", "left_anti").unionByName(kept.join(repeated, "key", "left_semi").dropDuplicates(["key"]))
    return named(kept, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark; of texts that share an id, those that hold none."""
    flat, _ = keyed(docs)
    found = decontaminate.contaminated(slim(flat, docs), table(spark, sf_dir, "benchmark"))
    return named(flat.join(found.select(F.col("doc_id").alias("key")).distinct(), "key", "left_anti"), docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document."""
    return mixing.mix_sources(docs)


STAGES = [
    ("language_id", language),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mix),
]

#: SuperMinHash, the SVD and the fitted classifier have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, since = table(spark, sf_dir, "documents"), len(STAGED)
    for name, step in STAGES:  # what a stage has read and made goes once its result is written
        docs = settle(step(spark, docs, sf_dir), f"pipeline-{name}", since)
    return docs
