"""A training-data pipeline over ``documents``.

Stages, each on all that the one before kept: language identification, line
deduplication, n-gram Jaccard join, benchmark decontamination, mixing sources
to target weights.  Each stage is written to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, langid, line_dedup, mixing, ngram_join
from tidemark.llm.scratch import thinned, without, written

#: A language prediction with a lower calibrated score is rejected.
LEAST_SCORE = 0.3


def _measured(docs: DataFrame) -> DataFrame:
    """n_chars, if there is one, follows the text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is recognised."""
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    return langid.keep_identified(docs, model, LEAST_SCORE)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove repeated lines; a document of which nothing is left goes."""
    out = line_dedup.dedup_lines(docs, removed_col="__removed")
    blank = F.coalesce(F.trim("text", F.lit(" \t\n\x0b\x0c\r")) == "", F.lit(False))
    return _measured(out.where((F.col("__removed") == 0) | ~blank).drop("__removed"))


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row, that of the smallest doc_id, of each group of near copies.

    Rows that repeat a doc_id are decided on one by one, by their own text: of
    those with equal texts one counts, that of the smallest other columns, and
    of near copies under one doc_id the one whose text has the smallest digest.
    """
    repeated = written(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"),
                       "pipeline-repeated")
    rows, key = docs, F.col("doc_id")
    if not repeated.isEmpty():
        others = [c for c in docs.columns if c not in ("doc_id", "text")]
        again = thinned(docs, "doc_id", repeated, "doc_id").join(repeated, "doc_id", "left_semi") \
            .groupBy("doc_id", "text").agg(F.min(F.struct(F.lit(0).alias("__none"), *others)).alias("__other")) \
            .select("doc_id", "text", *(F.col("__other")[c].alias(c) for c in others),
                    F.coalesce(F.sha2("text", 256), F.lit("")).alias("__place"))
        rows = written(without(docs, "doc_id", repeated, "doc_id").withColumn("__place", F.lit("")).unionByName(again), "pipeline-rows")
        key = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "__place"))
    rows = rows.withColumn("__key", key)
    classes = ngram_join.jaccard_classes(rows.select(F.col("__key").alias("doc_id"), "text"), k=5, num=80, den=100)
    copies = written(classes.where("doc_id <> component_id").select("doc_id"), "pipeline-copies")
    return without(rows, "__key", copies, "doc_id").select(*docs.columns)


def drop_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove contaminated documents, and benchmark spans from the others."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _measured(decontaminate.decontaminate(docs, benchmark))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the number of copies."""
    mixed = mixing.with_copies(docs, mixing.mix_plan(docs))
    return mixed.where("__mix.copies > 0").select(
        *docs.columns, F.col("__mix.size").alias("size"), F.col("__mix.copies").alias("copies"),
        (F.col("__mix.size") * F.col("__mix.copies")).alias("taken"), F.col("__mix.target").alias("target"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", join_near_copies),
    ("benchmark_decontamination", drop_benchmarks),
    ("source_mix", mix_sources),
]

#: Language identification cannot be expressed in SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
