"""The corpus pipeline: quality filter, exact dedup, near-dedup, substring dedup, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor
kept; all but the last return the columns of `documents`. A stage decides at once, keeps its
decisions as a narrow table and drops its other tables; what it returns is lazy and
reads ``docs`` and the decisions only, so stages can be chained with or without writing
between them. run() writes each stage's result to a folder of its own."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import quality
from sluice.llm.common import keep, own_tables, shared_dir, table
from sluice.llm.exact_dedup import exact_dedup
from sluice.llm.packing import best_fit_packing
from sluice.llm.simhash import simhash_dedup
from sluice.llm.substring_dedup import substring_dedup


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


_GAP = r"[\x20\x09-\x0D]+"


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps, as they are."""
    with own_tables(spark):
        model = quality.fit(docs)
    return quality.good_rows(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id; rows that repeat it: once."""
    with own_tables(spark):
        kept = keep(exact_dedup(docs).where("kept").select(
            F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__of"), "n_rows"), "kept")
    text = F.regexp_replace(F.coalesce("text", F.lit("")), _GAP, " ")
    # the kept rows are narrow, so they are hashed and the texts need no sort
    rows = docs.withColumn("__sha", F.sha2(text, 256))
    rows = rows.join(kept.hint("shuffle_hash"),
                     F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__sha") == F.col("__of")), "left_semi")
    if kept.where("n_rows > 1").limit(1).count():
        rows = rows.dropDuplicates(["doc_id", "__sha"])
    return rows.drop("__sha")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (4-word shingles, 4 bits) the document with the smallest id."""
    with own_tables(spark):
        kept = keep(simhash_dedup(docs, shingle=4, max_distance=4).where("kept").select(
            F.col("doc_id").alias("__id")).distinct(), "kept")
    return docs.join(kept.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the words that a smaller one has in a run of 50.

    A text that loses words becomes its kept words joined by one space, and n_chars
    its new length; the other texts stay as they are."""
    with own_tables(spark):
        cut = keep(substring_dedup(docs, window=50, with_text=True).where("n_removed > 0").select(
            F.col("doc_id").alias("__id"), F.col("words_sha256").alias("__of"), "kept_text").distinct(), "cut")
    words = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), _GAP, " "))
    both = docs.join(cut, (F.col("doc_id") == F.col("__id")) & (F.sha2(words, 256) == F.col("__of")), "left")
    new = {"text": F.coalesce("kept_text", "text"),
           "n_chars": F.when(F.col("kept_text").isNotNull(), F.length("kept_text").cast("long")).otherwise(
               F.col("n_chars"))}
    return both.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2048 tokens."""
    return best_fit_packing(docs, capacity=2048)


STAGES = [("quality classifier", quality_filter), ("exact dedup", exact), ("SimHash near-dedup", near),
          ("substring dedup", substrings), ("best-fit packing", packing)]

#: Neither the classifier nor the fingerprints nor the packing can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    folder = f"{shared_dir(spark)}/sluice-pipeline/{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{i}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{i}")
    return STAGES[-1][1](spark, docs, sf_dir)
