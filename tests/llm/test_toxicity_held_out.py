"""Held-out labels of the tables: what the model finds, and what it leaves alone."""

import os

import pytest

from millrace.llm.queries import op1_toxicity

SF = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are absent")
def test_held_out_rows_of_the_tables(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("toxic is not null").groupBy("doc_id").agg({"toxic": "max"}).withColumnRenamed("max(toxic)", "toxic")
    rows = op1_toxicity(spark, SF).where("held_out").join(labels, "doc_id").select("toxic", "predicted", "score").collect()
    toxic, clean = ([r for r in rows if r.toxic == t] for t in (1, 0))
    assert len(toxic) >= 50 and sum(r.predicted for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    pairs = [(a.score, b.score) for a in toxic for b in clean]
    assert sum((a > b) + 0.5 * (a == b) for a, b in pairs) / len(pairs) >= 0.95
