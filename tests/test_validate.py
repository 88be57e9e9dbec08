from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import metrics
from millrace.operators.quality import Gates, GateError, dedup, duplicates
from millrace.operators.validate import Rule, Run, validate
from millrace.plans.ingest import run_ingest
from millrace.schema import Field, Schema, conform, incompatibilities
from millrace.workspace import shared_folder

import pytest

SCHEMA = Schema.of(Field("id", "int64", False), Field("name", "string", False), Field("amount", "decimal", scale=2), Field("api_token", "int64"))


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, name string, amount string, api_token string")


def test_first_failure_wins_and_is_one_dead_letter(spark):
    v = validate(frame(spark, [("1", "a", "1.5", None), ("x", "", "y", None), ("2", None, "y", None), ("3", "c", "y", None)]), SCHEMA)
    assert [r.id for r in v.valid.collect()] == [1]
    assert sorted((r.failed_column, r.error_message) for r in v.dlq.collect()) == [
        ("amount", 'field "amount" (decimal) with value "y": type cast failed'),
        ("id", 'field "id" (int64) with value "x": type cast failed'),
        ("name", 'field "name" (string) with value "": non-nullable constraint violation'),
    ]
    assert v.audit.where("severity = 'ERROR'").count() == 3


def test_no_sensitive_value_leaves(spark):
    v = validate(frame(spark, [("1", "bob", "1", "hunter2")]), SCHEMA, sensitive=["NAME"])
    out = str(v.dlq.collect()) + str(v.audit.collect())
    assert "hunter2" not in out and "bob" not in out and "[REDACTED]" in out


def test_rules(spark):
    rows = frame(spark, [("1", "a", None, None), ("2", "b", "5", None), ("3", "z", "9", None)])
    v = validate(rows, SCHEMA, [Rule("not_null", "amount"), Rule("accepted_values", "name", ("a", "b")), Rule("condition", "amount", condition=F.coalesce(F.col("amount"), F.lit(0)) < 5, action="fail")])
    assert sorted(r.id for r in v.valid.collect()) == [1, 2]
    assert [(r.event_type, r.column_name) for r in v.audit.where("severity = 'WARNING'").collect()] == [("quality_warning", "amount")]
    assert [(r.rule, r.n) for r in v.broken("fail").collect()] == [("condition", 1)]


def test_empty_input_and_missing_columns(spark):
    v = validate(spark.createDataFrame([], "other string"), SCHEMA)
    assert v.valid.count() == v.dlq.count() == v.audit.count() == 0
    assert [r.failed_column for r in validate(spark.createDataFrame([("x",)], "other string"), SCHEMA).dlq.collect()] == ["id"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(*[st.one_of(st.none(), st.text(max_size=6), st.integers().map(str))] * 4), max_size=20))
def test_every_row_has_one_outcome(spark, rows):
    raw = frame(spark, rows).withColumn("_source_file", F.lit("f"))
    v = validate(raw, SCHEMA)
    assert raw.count() == v.valid.count() + v.dlq.count()
    assert all(r.conserved for r in metrics.conservation(metrics.origin_metrics(v.tagged), metrics.source_counts(raw, "_source_file")).collect())


def test_one_scan_and_no_single_partition(spark, tmp_path):
    frame(spark, [("1", "a", "1", None)] * 50).write.parquet(str(tmp_path / "t"))
    v = validate(spark.read.parquet(str(tmp_path / "t")), SCHEMA)
    plan = metrics.origin_metrics(v.tagged)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "SinglePartition" not in plan and "partial_count" in plan


def test_run_ingest(spark):
    rows = frame(spark, [(str(i), "n", "1", None) for i in range(40)] + [("x", "n", "1", None)] * 2)
    out = shared_folder(spark)
    r = run_ingest(rows, SCHEMA, out, gates=Gates(max_error_percentage=10), offset=5, run=Run(pipeline_id="p"), custom={"top": F.max("id")})
    assert (r.total_read, r.valid, r.dlq, r.watermark, r.stats["files"] > 0) == (42, 40, 2, "47", True)
    assert r.custom == {"top": 39} and r.invalid_counts["invalid_value_count_id"] == 2
    assert spark.read.parquet(f"{out}/data").count() == 40 and spark.read.json(f"{out}/quarantine/dead_letters").count() == 2
    for gates, unique in ((Gates(max_error_percentage=1), ()), (Gates(dlq_enabled=False), ()), (Gates(row_count_min=100), ()), (Gates(), ("name",))):
        with pytest.raises(GateError):
            run_ingest(rows, SCHEMA, shared_folder(spark), gates=gates, unique=unique)


def test_wide_schema(spark):
    wide = Schema.of(*(Field(f"c{i}", "int64") for i in range(120)))
    row = spark.range(3).select(*(F.lit(str(i)).alias(f"c{i}") for i in range(120)))
    assert validate(row, wide).valid.count() == 3


def test_schema_evolution_and_conform(spark):
    old = Schema.from_json('{"fields":[{"name":"order_id","type":"int64","nullable":false},{"name":"customer"}]}')
    assert incompatibilities(old, Schema.of(*old.fields, Field("discount", "decimal", scale=2))) == []
    assert len(incompatibilities(old, Schema.of(Field("order_id", "string"), Field("new", nullable=False)))) == 3
    got = conform(spark.createDataFrame([("c", 1)], "CUSTOMER string, x int"), old)
    assert got.columns == ["order_id", "customer"] and got.first() == (None, "c")
    for bad in ("uuid",):
        with pytest.raises(ValueError):
            Field("x", bad)


def test_dedup_and_duplicates(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (None, "z"), (None, "y"), (2, "c")], "k int, v string")
    assert sorted((r.k or 0, r.v) for r in dedup(df, ["k"], ["v"]).collect()) == [(0, "y"), (1, "a"), (2, "c")]
    assert [(r.k, r.n) for r in duplicates(df, ["k"]).collect()] == [(1, 2)]


def test_dedup_ties_are_decided_by_content(spark):
    rows = [(1, 0, f"v{i}") for i in range(50)]
    kept = {dedup(spark.createDataFrame(r, "k int, o int, v string").repartition(n), ["k"], ["o"]).first().v for r, n in ((rows, 1), (rows[::-1], 1), (rows, 7))}
    assert len(kept) == 1
