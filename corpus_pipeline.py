"""Corpus preparation: five stages from raw documents to packed training sequences.

Each stage gets what its predecessor kept, as a table, and returns the columns of documents;
the last one returns the pieces and their places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.line_dedup import dedup_lines
from millrace.llm.mixing import mix
from millrace.llm.near_dup import near_duplicates
from millrace.llm.packing import pack
from millrace.llm.queries import tokenizer_path
from millrace.llm.shared import table, written
from millrace.llm.toxicity import toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model calls toxic go. Rows that repeat an id go if one of them does; rows
    without an id are judged each for itself."""
    named = docs.where("doc_id is not null")
    # numbers of their own, far from all ids, in a table so that they stay as they are
    number = F.lit(-(1 << 63)) + F.monotonically_increasing_id()
    unnamed = written(docs.where("doc_id is null").withColumn("toxicity_row", number))
    every = named.select("doc_id", "text").union(unnamed.select("toxicity_row", "text"))
    rejected = toxicity(every, table(spark, sf_dir, "labels")).where("predicted = 1").select(F.col("doc_id").alias("toxicity_row")).distinct()
    kept = unnamed.join(rejected, "toxicity_row", "left_anti").select(docs.columns)
    return named.join(rejected, F.col("doc_id") == F.col("toxicity_row"), "left_anti").union(kept)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines are cut out of the texts. A document that had words and
    has none left was a copy in full, and goes; n_chars follows the text."""
    out = dedup_lines(docs, whole_runs=True)
    gone = (F.col("n_deleted") > 0) & ~F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    out = out.where(F.coalesce(~gone, F.lit(True)))
    return out.withColumn("n_chars", F.when(F.col("n_deleted") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (0.8 or more of their five-word shingles) stays: the one with the smallest id."""
    copies = near_duplicates(docs, percent=80).where("not kept").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, 0 to 2 times. Rows that repeat an id are
    taken as often as the one that is taken most."""
    times = mix(docs).groupBy(F.col("doc_id").alias("mixed_id")).agg(F.max("times").alias("mixed_times")).where("mixed_times > 0")
    rows = docs.join(times, F.col("doc_id").eqNullSafe(F.col("mixed_id")))
    return rows.withColumn("mixed_turn", F.explode(F.sequence(F.lit(1), "mixed_times"))).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL cannot express the toxicity model or the tokenizer, so tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
