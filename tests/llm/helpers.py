"""Small tables with the awkward rows that every operator must bear."""

import os
import re

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
AWKWARD = [
    (1, "alpha beta gamma delta epsilon zeta eta theta", "a"),
    (2, "alpha beta gamma delta epsilon zeta eta theta", "a"),
    (2, "alpha beta gamma delta epsilon zeta eta theta", "a"),
    (3, None, None),
    (4, "", "b"),
    (5, " \t\n ", "b"),
    (6, "one", "b"),
    (7, LONG, "c"),
    (8, LONG + " tail", "c"),
    (None, "a row without an id that has some words in it", "c"),
    (None, None, None),
    (9, "é😀 ünï code \x00 nul\nsecond line here\r\nthird", None),
    (10, "ALPHA Beta gamma delta epsilon zeta eta theta", "a"),
]


def awkward(spark, columns="doc_id long, text string, source string"):
    """With extra columns under the names that the operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(AWKWARD, columns)
    clash = ("row", "line", "lines", "marks", "cuts", "doc", "version", "size", "key", "rep", "component", "pivot", "n", "bands", "piece", "shard", "target", "taken", "digest", "payload", "spans", "score", "toxic", "range", "copy", "edited")
    return df.select("*", *(F.lit("x").alias(c) for c in clash))


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, lang string, n_chars long")


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
