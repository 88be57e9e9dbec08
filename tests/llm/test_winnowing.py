"""Line dedup: equal lines only, thinned positions, hot lines."""

from helpers import awkward, empty
from pyspark.sql import functions as F

from millrace.llm.line_dedup import dedup_lines, windows
from millrace.llm.shared import joined


def lines(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_lines_equal_under_a_short_hash_stay(spark):
    words = F.concat_ws(" ", *(F.concat(F.lit(f"w{i}x"), F.col("id")) for i in range(12)))
    pair = spark.range(400_000).select(words.alias("t"), F.hash(words).alias("h")).groupBy("h").agg(F.min("t").alias("a"), F.max("t").alias("b")).where("a <> b").first()
    common = "a line that both of the documents have, ten words long"
    rows = [(1, f"{common}\n{pair.a}"), (2, f"{common}\n{pair.b}"), (3, f"{pair.a}\n{pair.b}")]
    for whole in (False, True):
        got = {r.doc_id: (r.text, r.n_deleted) for r in dedup_lines(lines(spark, rows), whole_runs=whole).collect()}
        assert got == {1: (rows[0][1], 0), 2: (pair.b, 1), 3: ("", 2)}


def test_positions_are_thinned_and_shared(spark):
    """Of twenty short lines a few are selected; those within a shared run are the same ones."""
    run = "\n".join(f"run{i} line" for i in range(20))
    rows = [(1, "one two three\n" + run), (2, "four\nfive six\nseven\n" + run + "\nend of it")]
    docs = lines(spark, rows).select(F.col("doc_id").alias("doc"), F.lit(0).alias("version"), "text")
    heads = windows(docs).where("head")
    by = {d: [r.fingerprint for r in heads.where(F.col("doc") == d).orderBy("line").collect()] for d in (1, 2)}
    assert 4 <= len(set(by[1]) & set(by[2])) and max(map(len, by.values())) <= 16
    assert len({(r.doc, r.position) for r in heads.collect()}) == heads.count()


def test_line_that_every_document_has(spark):
    rows = [(i, f"own line {i}\nthis line of ten words stands in every one of them\nlast {i}") for i in range(3000)]
    got = dedup_lines(lines(spark, rows), whole_runs=True)
    assert got.agg(F.sum("n_deleted")).first()[0] == 2999


def test_joined_keeps_every_row(spark):
    rows = spark.range(5000).select((F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))).alias("k"), "id")
    keyed = rows.groupBy("k").agg(F.count("*").alias("n"))
    got = joined(rows, keyed, ["k"])
    assert sorted(tuple(r) for r in got.collect()) == sorted((7 if i % 3 == 0 else i, i, 1668 if i % 3 == 0 or i == 7 else 1) for i in range(5000))


def test_awkward_whole_runs(spark):
    df = awkward(spark)
    got = dedup_lines(df, whole_runs=True)
    assert got.columns == [*df.columns, "n_lines", "n_deleted"] and got.count() == df.count()
    assert [r.text for r in got.collect() if r.doc_id == 3] == [None]
    assert dedup_lines(empty(spark), whole_runs=True).count() == 0
