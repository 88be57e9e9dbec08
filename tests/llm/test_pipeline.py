import corpus_pipeline
from helpers import SF, documents
from test_free_ops import check_packing
from test_line_runs import brute_runs
from test_near_dup import brute

from millrace.llm.mixing import mix
from millrace.llm.shared import written
from millrace.llm.toxicity import toxicity


def test_each_stage_against_a_plain_version(spark):
    docs = documents(spark)
    stages = dict(corpus_pipeline.STAGES)
    rows = {r.doc_id: r.text for r in docs.collect()}

    toxic = {r.doc_id for r in toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1").collect()}
    docs = written(stages["toxicity"](spark, docs, SF))
    rows = {d: t for d, t in rows.items() if d not in toxic}
    assert {r.doc_id: r.text for r in docs.collect()} == rows

    before, docs = rows, written(stages["line_dedup"](spark, docs, SF))
    rows = {d: t for d, t in brute_runs(list(before.items())).items() if t.split() or t == before[d]}
    assert {r.doc_id: (r.text, r.n_chars) for r in docs.collect()} == {d: (t, len(t)) for d, t in rows.items()}

    docs = written(stages["near_dedup"](spark, docs, SF))
    kept = {d for d, (_, _, k) in brute(list(rows.items())).items() if k}
    rows = {d: t for d, t in rows.items() if d in kept}
    assert {r.doc_id: r.text for r in docs.collect()} == rows

    times = {r.doc_id: r.times for r in mix(docs).collect()}
    docs = written(stages["mixing"](spark, docs, SF))
    want = sorted(d for d, n in times.items() for _ in range(n))
    assert sorted(r.doc_id for r in docs.collect()) == want and docs.columns == documents(spark).columns

    check_packing(stages["packing"](spark, docs, SF).collect(), [(d, rows[d]) for d in want])


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100 and len(corpus_pipeline.STAGES) == 5
