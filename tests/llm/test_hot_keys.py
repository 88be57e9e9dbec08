"""Keys with a third of all rows: whole results, and no task that has them all."""

import pytest
from helpers import LONG
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.line_dedup import dedup_lines
from millrace.llm.near_dup import near_duplicates
from millrace.llm.packing import pack
from millrace.llm.queries import tokenizer_path
from millrace.llm.shared import MOST_HOT, dealt, hot_from, joined, written
from millrace.llm.warc import round_trip


def skewed(spark, n=30_000):
    """A third of the rows have key 7, the others 500 keys."""
    return written(spark.range(n).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(1000 + F.col("id") % 500).alias("k")))


def largest_partition(df):
    return df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]


def test_dealt_joins_all_and_spreads_hot_keys(spark):
    rows = skewed(spark)
    keyed = rows.select("k").distinct().select("k", F.concat(F.lit("v"), "k").alias("v"))
    keyed = keyed.union(keyed.where("k = 7").select("k", F.lit("second")))  # several rows for a key
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = dealt(rows, keyed, "k", "id", rows)
        assert got.columns == ["k", "id", "v"]
        assert got.count() == rows.join(keyed, "k").count() == got.distinct().count()
        assert got.exceptAll(rows.join(keyed, "k").select(*got.columns)).isEmpty()
        # 20,000 of 40,000 joined rows have the hot key
        assert largest_partition(got) < 12_000 < 20_000 < largest_partition(rows.join(keyed, "k"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_joined_keeps_all_rows(spark):
    rows = skewed(spark)
    got = joined(rows, rows.groupBy("k").agg(F.count("*").alias("n")), ["k"])
    assert got.count() == 30_000 and got.where("k = 7").select("n").distinct().collect() == [(10_000,)]
    assert joined(rows.limit(0), rows.limit(0).groupBy("k").agg(F.count("*").alias("n")), ["k"]).count() == 0


@pytest.mark.parametrize("total", [0, 10, 10**6, 10**10, 10**12, 10**15])
def test_hot_keys_are_bounded_in_rows_and_number(total):
    limit = hot_from(total)
    assert total <= limit * MOST_HOT  # so fewer than MOST_HOT keys can have more rows
    assert limit <= max(10_000_000, total / MOST_HOT)


def test_hub_of_most_edges(spark):
    edges = [(0, i) for i in range(1, 2000)] + [(i, i + 1) for i in range(5000, 5050)] + [(1999, 5000)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == 2051 and {r.component for r in got} == {0}


def test_near_copies_of_one_pivot(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[:390] + [f"own{i}x{j}" for j in range(10)])) for i in range(300)]
    rows += [(1000 + i, " ".join(f"other{i}y{j}" for j in range(40))) for i in range(300)]
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == 0 for i in range(300)) and all(got[i] == i for i in range(1000, 1300))


def test_a_null_id_is_not_the_largest_id(spark):
    text = "one two three four five six seven eight nine ten eleven\nlast line with some words in it here now ok"
    top = (1 << 63) - 1
    docs = spark.createDataFrame([(None, text), (None, text), (top, text)], "doc_id long, text string")
    got = sorted(((r.doc_id is None, r.text, r.n_deleted) for r in dedup_lines(docs, whole_runs=True).collect()), key=str)
    assert got == [(False, text, 0), (True, "", 2), (True, "", 2)]


def test_archives_of_pages_without_ids(spark):
    rows = [(None, None, "<p>same</p>")] * 60 + [(3, "http://a", "<p>same</p>"), (4, "http://b", "<p>same</p>"), (3, "http://a", "<p>same</p>")]
    got = round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in got) == [(0, "response", 0)] * 60 + [(3, "response", 0)] * 2 + [(4, "revisit", 3)]


def test_rows_that_repeat_are_packed_in_many_shards(spark):
    docs = spark.createDataFrame([(1, "some words of one text")] * 600 + [(2, LONG[:6000])], "doc_id long, text string")
    got = pack(docs, tokenizer_path(), shard=50).collect()
    assert sum(r.doc_id == 1 for r in got) == 600 and len({r.sequence_id >> 36 for r in got if r.doc_id == 1}) > 5
    places: dict[int, list] = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in places.values():
        p.sort()
        assert p[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(p, p[1:])) and sum(p[-1]) <= 1024
