"""Corpus pipeline: language ID, line dedup, near-duplicates, decontamination, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it left; its result is written as Parquet and read again.  All stages but
the last return the columns of ``documents``; the last returns the pieces of the
packed sequences.

The near-duplicate stage decides by row, whatever the ids: of repeated rows one
stays, and rows without an id are compared like any other.  Null texts go in the
first stage, which keeps texts of a learned language only; a document whose every
line repeats an earlier one goes in the second.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellcast.llm import decontam, language_id, line_dedup, ngram_join, packing
from cellcast.session import cut_lineage


def keep_learned_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in none of the labelled languages, go."""
    return language_id.keep_identified(docs, language_id.learn_filters(docs))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go from the texts, and documents without a word left go with them."""
    cleaned, _ = line_dedup.dedup_lines(docs)
    left = cleaned.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return left.withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicate rows one stays: the smallest id (null last), then the first row."""
    # Written, so a row keeps its number in every later job.
    rows = cut_lineage(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    groups = ngram_join.near_duplicates(rows, id_col="__row")
    near = cut_lineage(groups.where("component_id <> __row").select("__row", "component_id"), "near")
    roots = near.select(F.col("component_id").alias("__row"), "component_id").distinct()
    members = near.unionAll(roots).join(rows.select("__row", "doc_id"), "__row")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row")
    first = members.groupBy("component_id").agg(F.min(order).alias("first"))
    gone = members.join(first, "component_id").where("__row <> first.__row").select("__row")
    return rows.join(gone, "__row", "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    benchmark = spark.read.parquet(os.path.join(sf_dir, "benchmark.parquet"))
    return decontam.keep_clean(docs, benchmark)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1,024 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", keep_learned_languages),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("pack", pack_sequences),
]

#: Learned filters and token ids are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
