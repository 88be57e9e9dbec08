"""Every stage of the pipeline with nulls, empty texts, repeated rows, clashing names and no rows."""

import corpus_pipeline
import pytest
from helpers import AWKWARD, SF, awkward, documents, empty
from pyspark.sql import functions as F

from millrace.llm.shared import written

STAGES = dict(corpus_pipeline.STAGES)


def rough(spark):
    return awkward(spark).withColumn("lang", F.lit(None).cast("string")).withColumn("n_chars", F.length("text").cast("long"))


@pytest.mark.parametrize("name", list(STAGES))
def test_awkward_rows(spark, name):
    df = rough(spark)
    got = STAGES[name](spark, df, SF)
    if name != "packing":
        assert got.columns == df.columns
    rows = got.collect()
    texts = {(r.doc_id, r.text) for r in rows} if name != "packing" else set()
    if name == "toxicity":  # nothing here is toxic
        assert len(rows) == len(AWKWARD)
    elif name == "line_dedup":  # short lines are no repetitions; the null text stays null
        assert len(rows) == len(AWKWARD) and (3, None) in texts and all(r.row == "x" and r.marks == "x" for r in rows)
    elif name == "near_dedup":  # 2 and 10 copy 1, 8 is near 7; rows without id or words stay
        assert {r.doc_id for r in rows} == {1, 3, 4, 5, 6, 7, 9, None} and sum(r.doc_id is None for r in rows) == 2
    elif name == "mixing":  # ids whose texts are null or wordless are never taken (rows without an id share one), no row more than twice for each time it stands
        assert rows and not {3, 4, 5} & {r.doc_id for r in rows} and max(sum(r == x for x in rows) for r in rows) <= 4
    else:
        assert {r.doc_id for r in rows} == {d for d, _, _ in AWKWARD}


@pytest.mark.parametrize("name", list(STAGES))
def test_no_rows(spark, name):
    assert STAGES[name](spark, empty(spark), SF).count() == 0


def test_stages_keep_the_columns_of_documents(spark):
    docs = documents(spark).limit(30)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name


def test_toxic_rows_without_an_id_go(spark):
    """A toxic text goes whether its row has an id or not; what stands beside it stays."""
    sf = "/root/testdata/sf0.01"  # the smallest tables have too few labels
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = written(STAGES["toxicity"](spark, docs, sf))
    gone = docs.join(kept, "doc_id", "left_anti").limit(3)
    stay = kept.limit(3)
    assert gone.count() == 3
    nameless = gone.union(stay).withColumn("doc_id", F.lit(None).cast("long"))
    got = STAGES["toxicity"](spark, docs.union(nameless), sf)
    assert sorted(r.text for r in got.where("doc_id is null").collect()) == sorted(r.text for r in stay.collect())
    assert got.where("doc_id is not null").count() == kept.count()
