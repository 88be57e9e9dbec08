import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.incremental import Mark, compared, incremental_query, newer, next_mark, next_offset
from millrace.operators.slices import Slice, assign, collect_slices, contiguous, exact_buckets, objectid_slices
from millrace.schema import Field, Schema


@pytest.mark.parametrize("n,batch", [(0, 5), (1, 5), (37, 5), (40, 5)])
def test_buckets_are_those_of_a_row_number(spark, n, batch):
    rng = random.Random(n)
    keys = sorted(rng.choices(range(15), k=n))
    got = exact_buckets(spark.createDataFrame([(k,) for k in keys] + [(None,)], "k long"), "k", batch).collect()
    want = [(i + 1, min(c), max(c), len(c)) for i, c in enumerate(keys[j : j + batch] for j in range(0, n, batch))]
    assert sorted(tuple(r) for r in got) == want


def test_every_row_is_in_one_slice(spark):
    keys = [None, None, 3, 3, 3, 3, 3, 7, 9, 9, 20, -4, 11]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    cuts = collect_slices(contiguous(exact_buckets(df, "k", 2)))
    parts = [df.where(s.predicate("k", str) or "true").collect() for s in cuts]
    assert sum(map(len, parts)) == len(keys)
    by_assign = {r[0]: r[1] for r in df.groupBy(assign(F.col("k"), cuts)).count().collect()}
    assert by_assign == {s.index: len(p) for s, p in zip(cuts, parts, strict=True) if p}


def test_no_bucket_is_one_open_slice(spark):
    none = exact_buckets(spark.createDataFrame([], "k long"), "k", 5)
    assert collect_slices(contiguous(none)) == [Slice(0, None, None, True, True)]


def test_objectid_slices(spark):
    ids = ["00000064" + "0" * 16, "000000c8" + "f" * 16]
    got = objectid_slices(spark.createDataFrame([(i,) for i in ids], "id string"), "id", 2).orderBy("slice_index").collect()
    assert [(r.lower_bound, r.upper_bound) for r in got] == [(ids[0], "00000096" + "0" * 16), ("00000096" + "0" * 16, ids[1])]
    one = objectid_slices(spark.createDataFrame([(ids[0],)], "id string"), "id", 4).collect()
    assert [(r.lower_bound, r.upper_bound, r.is_first, r.is_last) for r in one] == [(ids[0], ids[0], True, True)]


def test_marks():
    assert Mark("a", "integer", "10").compare(Mark("a", "integer", "9")) == 1
    assert Mark("a", "timestamp", "2026-01-01T10:00:00+02:00").compare(Mark("a", "timestamp", "2026-01-01T09:00:00+00:00")) == -1
    assert Mark("a", "timestamp", "2026-01-01T10:00:00.5+02:00").canonical() == "2026-01-01T08:00:00.5+00:00"
    assert Mark("a", "string", "o'x").literal() == "'o''x'"
    for kind, bad in (("integer", "1.5"), ("float", "NaN"), ("timestamp", "24/10/2026"), ("date", "2026-13-40"), ("integer", "9223372036854775808")):
        with pytest.raises(ValueError):
            Mark("a", kind, bad)
    for column in ("a b", "a;--", ""):
        with pytest.raises(ValueError):
            Mark(column, "integer")
    with pytest.raises(ValueError):
        Mark("a", "integer").check(Schema.of(Field("a", "string")))


def test_incremental_query():
    assert incremental_query("SELECT 1", Mark("id", "integer", "5")) == "SELECT * FROM (SELECT 1) newer_rows WHERE id > 5"
    assert incremental_query("SELECT * FROM t WHERE x > :watermark_value", Mark("x", "date", "2026-01-02")).endswith("x > '2026-01-02'")
    with pytest.raises(ValueError):
        incremental_query("x > :watermark_value", None)


def test_next_mark(spark):
    df = spark.createDataFrame([(1, "2026-01-01 00:00:00"), (5, "2026-01-02 00:00:00.25"), (None, None)], "id long, t string").withColumn("at", F.col("t").cast("timestamp"))
    mark = Mark("id", "integer", "3")
    assert next_mark(df, mark).text == "5" and newer(df, mark).count() == 1
    assert next_mark(df, Mark("id", "integer", "9")).text == "9"
    assert next_mark(df.where("id is null"), Mark("id", "integer", " 3")).text == " 3"
    assert next_mark(df, Mark("at", "timestamp")).text == "2026-01-02T00:00:00.25+00:00"
    assert newer(df, Mark("at", "timestamp", "2026-01-01T00:00:00Z")).count() == 1
    assert next_offset(None, 7) == 7 and next_offset(5, 7) == 12


def test_marks_of_a_column_compare_as_marks_do(spark):
    cases = {
        "integer": ("9", ["10", "-1", "9", " 9 ", None]),
        "float": ("0.5", ["0.25", "1e3", "0.50", None]),
        "date": ("2026-01-02", ["2026-01-01", "2026-01-02", "2026-02-01", None]),
        "string": ("b", ["a", "b", "ba", "", None]),
        "timestamp": ("2026-01-01T09:00:00+00:00", ["2026-01-01T10:00:00+02:00", "2026-01-01 09:00:00", "2026-01-01T09:00:00.000001Z", "2026-01-01", "2026-01-02", None]),
    }
    for kind, (at, texts) in cases.items():
        mark = Mark("a", kind, at)
        got = [r.c for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(compared(F.col("t"), mark).alias("c")).collect()]
        assert got == [None if t is None else Mark("a", kind, t).compare(mark) for t in texts], kind
