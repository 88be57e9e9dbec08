"""What the plans must look like for the jobs to hold at scale."""

import re

import pytest

from millrace.operators import metrics, quality, slices
from millrace.operators.incremental import Mark, newer
from millrace.operators.validate import validate
from millrace.schema import Field, Schema


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "t")
    spark.range(1000).selectExpr("id", "id % 7 AS k", "cast(id AS string) AS a", "timestamp_seconds(id) AS at", "uuid() AS wide").write.parquet(path)
    return spark.read.parquet(path)


def test_marks_and_slices_reach_the_scan(table):
    assert "GreaterThan(id,5)" in plan(newer(table, Mark("id", "integer", "5")))
    assert re.search(r"PushedFilters: \[[^]]*GreaterThan\(at,", plan(newer(table, Mark("at", "timestamp", "1970-01-01T00:00:05Z"))))
    s = slices.Slice(1, 10, 20, False, False)
    assert "GreaterThanOrEqual(id,10)" in plan(table.where(s.predicate("id", str)))


def test_only_needed_columns_are_read(table):
    schema = re.search(r"ReadSchema: (\S+)", plan(quality.duplicates(table, ["k"])))[1]
    assert schema == "struct<k:bigint>"


def test_aggregates_combine_before_the_shuffle(table):
    assert "partial_min_by" in plan(quality.dedup(table.select("k", "a"), ["k"], ["a"]))
    v = validate(table.select("a"), Schema.of(Field("a", "int64")))
    text = plan(metrics.origin_metrics(v.tagged))
    assert "partial_count" in text and "SinglePartition" not in text


def test_validation_stays_in_the_jvm(table):
    v = validate(table.select("a"), Schema.of(Field("a", "int64"), Field("b", "decimal", scale=2)))
    for df in (v.valid, v.dlq, v.audit):
        assert not re.search("Python|Pandas|Arrow|Exchange", plan(df))


def test_exact_buckets_have_no_window_over_all_rows(table):
    text = plan(slices.exact_buckets(table, "id", 100))
    for window in re.findall(r"Window \[.*", text):
        assert "part" in window or "rows" in window


def test_each_text_is_trimmed_and_cast_once(table):
    schema = Schema.of(Field("a", "int64"), Field("b", "decimal", scale=2), Field("c", "timestamp", False), Field("d", "bool"))
    raw = table.select("a", *(table.a.alias(c) for c in "bcd"))
    v = validate(raw, schema)
    for df in (v.valid, v.dlq, v.tagged.groupBy("_origin").count()):
        text = df._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("trim(") <= 4 and text.lower().count("decimal(18,2)") <= 2, text
