"""The near-dedup stage links from 0.80."""

import corpus_pipeline
from helpers import documents
from test_near_dup import brute, result, shingles

from millrace.llm.near_dup import near_duplicates


def edited(i, edits):
    words = [f"d{i}w{j}" for j in range(100)]
    for e in edits:
        words[e] = f"d{i}e{e}"
    return " ".join(words)


def test_pairs_between_080_and_085(spark):
    rows = [(10 * i + n, edited(i, e)) for i in range(200) for n, e in enumerate(([], [30, 60]))]
    rows += [(10 * i + n, edited(i, e)) for i in range(200, 220) for n, e in enumerate(([], [20, 50, 80]))]
    a, b = shingles(rows[0][1]), shingles(rows[1][1])
    assert 0.8 <= len(a & b) / len(a | b) < 0.85
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, df, "").collect()}
    assert kept == {d for d, _ in rows} - {10 * i + 1 for i in range(200)}


def test_tables_at_080(spark):
    docs = documents(spark)
    assert result(near_duplicates(docs, percent=80)) == brute([(r.doc_id, r.text) for r in docs.collect()], 80)
