"""What only tables of many files, or many slices, bring out."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from millrace import queries
from millrace.operators.slices import by_condition, collect_slices, contiguous, exact_buckets
from millrace.sources.jdbc import literal


def rows_of(spark, path, n, files, key="o_orderkey"):
    """Orders 0 to n - 1 dealt over so many files."""
    status = F.element_at(F.array(*map(F.lit, "FOP")), (F.col(key) % 3 + 1).cast("int"))
    rows = spark.range(n).select(F.col("id").alias(key), (F.col("id") % 7).alias("o_custkey"), status.alias("o_orderstatus"), (F.col("id") * 1.25).alias("o_totalprice"), F.timestamp_seconds("id").alias("o_orderdate"), F.lit("2-HIGH").alias("o_orderpriority"))
    rows.repartition(files, F.col(key) % 97).write.parquet(f"{path}/orders.parquet")
    return str(path)


def test_published_parts_keep_their_order(spark, tmp_path):
    """rows that come from several tasks are in the order that they were sorted in."""
    orders = spark.read.parquet(rows_of(spark, tmp_path, 3000, 6) + "/orders.parquet").selectExpr(*queries._RECORD, "o_orderstatus AS part")
    queries._write_by_part(orders, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out").select("id", "part", F.col("_metadata.row_index").alias("at")).orderBy("part", "at").collect()
    assert [(r.part, r.id) for r in back] == sorted((r.part, r.id) for r in back) and len(back) == 3000


def test_published_parts_have_one_digest(spark, tmp_path):
    """also if keys repeat."""
    path = rows_of(spark, tmp_path, 3000, 6)
    spark.read.parquet(f"{path}/orders.parquet").write.mode("append").parquet(f"{path}/orders.parquet")
    got = queries.single_file_stats(spark, path).collect()
    assert [tuple(r) for r in got] == [(6000, 3, True, True, True)]


@pytest.mark.parametrize("kind,keys", [("long", [None, None, 3, 3, 3, 3, 3, 7, 9, 9, 20, -4, 11]), ("date", [None, *(date(2026, 1, 1) + timedelta(i * i) for i in range(9))]), ("long", [None, None]), ("long", [])])
@pytest.mark.parametrize("size", [1, 2, 100])
def test_one_pass_has_the_rows_of_a_read_per_slice(spark, kind, keys, size):
    """each row in the slice whose own condition it meets."""
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], f"k {kind}, i int")
    cuts = collect_slices(contiguous(exact_buckets(df, "k", size)))
    want = sorted((s.index, r.i) for s in cuts for r in df.where(s.predicate("k", literal) or "true").collect())
    got = sorted((r.slice_index, r.i) for r in by_condition(df, "k", cuts).collect())
    assert got == want and sorted(i for _, i in got) == list(range(len(keys)))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_jdbc_slices_are_not_scans_of_their_own(spark, tmp_path):
    """the plan is as large for 12 slices as for one."""
    read = queries.jdbc_slices(spark, rows_of(spark, tmp_path, 60_001, 2))
    assert plan(read).count("FileScan") == 1
    got = read.agg(F.count("*"), F.sum("k"), F.count_if(F.col("slice_key").isNull())).first()
    assert tuple(got) == (60_001 - 101, 60_000 * 60_001 // 2 - 5050, 1200 - 2)


def test_conditions_reach_the_scan(spark, tmp_path):
    """What a slice that is read alone asks for is asked of the files."""
    orders = spark.read.parquet(rows_of(spark, tmp_path, 300, 2) + "/orders.parquet")
    cuts = collect_slices(contiguous(exact_buckets(orders, "o_orderkey", 100)))
    assert "GreaterThanOrEqual(o_orderkey,100), LessThan(o_orderkey,200)" in plan(orders.where(cuts[1].predicate("o_orderkey", literal)))


def test_slice_predicates_are_not_scans_of_their_own(spark, tmp_path):
    """the plan is as large for 25 slices as for one."""
    read = queries.slice_predicates(spark, rows_of(spark, tmp_path, 60_001, 2))
    assert plan(read).count("FileScan") == 1
    assert [tuple(r) for r in read.orderBy("slice_index").collect()] == [(i, min(2500, 60_001 - i * 2500), i * 2500, min(i * 2500 + 2499, 60_000)) for i in range(25)]
