"""Mixing sources to target weights by weighted fair queueing.

Every source sends its documents in shuffled order, the whole source again once it has run
out. A document's virtual finish time is the words its source has sent up to and including
it, divided by the source's target; the mix is the documents in the order of finish times
until the total budget is spent.

Running sums over a source (one may hold a third of all rows) never run in one task: rows
are dealt by a hash into cells, cells get their sums first, and the sum of the cells before
is added to the sum inside a cell. The global order is found the same way, by ranges of
finish time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import WORD, written

#: Rows in a cell, on average.
CELL_ROWS = 2_000
SEED = "mix-1"


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), percent: int = 150, cap: int = 2) -> DataFrame:
    """(source_rank, source_size, target) from (source_rank, source_size): one row per source.

    Sources share ``percent`` of all words by repeating weights; a target stops at ``cap``
    times its source and what is left is shared by weight among the others, until none is
    above. Written as the level L at which sum(min(cap * size, weight * L)) is the amount:
    with the sources in the order of cap * size / weight, the first ones are at their cap.
    """
    total = F.sum("source_size").over(Window.partitionBy())
    cut = F.col("source_size") * cap / F.col("weight")
    order = Window.partitionBy().orderBy("cut", "source_rank")  # one row per source
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_rank") % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("cut", cut).withColumn("amount", total * F.lit(percent) / 100)
    rows = rows.withColumn("capped", F.sum(F.col("source_size") * cap).over(order) - F.col("source_size") * cap).withColumn("open", F.sum("weight").over(Window.partitionBy()) - F.sum("weight").over(order) + F.col("weight"))
    rows = rows.withColumn("level", (F.col("amount") - F.col("capped")) / F.col("open"))
    level = F.max(F.when(F.col("level") <= F.col("cut"), F.col("level"))).over(Window.partitionBy())
    return rows.select("source", "source_rank", "source_size", F.when((F.col("cut") <= level) | level.isNull(), F.col("source_size") * F.lit(float(cap))).otherwise(F.col("weight") * level).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1), percent: int = 150, cap: int = 2, seed: str = SEED, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words), times.

    A word is a run of characters other than space and U+0009 to U+000D. Sources by code
    point, the null source last, weigh ``weights``, repeating. ``times`` is how often the mix
    holds the document (0 to ``cap``), taken = times * size. The shuffle is a hash of seed, id
    and size, so reruns agree; rows that are alike in these (repeated rows) tie and may be
    counted in either order. Null and wordless texts have size 0 and are never taken. A null
    id is shuffled like any other. An empty table gives an empty result.
    """
    size = F.size(F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD), F.lit(0))).cast("long")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"))
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("size").cast("string")))
    rows = written(rows.withColumn("shuffled", key))
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    ranked = written(sources.withColumn("source_rank", F.row_number().over(Window.partitionBy().orderBy(F.col("source").asc_nulls_last())) - 1))
    goals = targets(ranked, weights, percent, cap)
    count = ranked.agg(F.sum("n")).first()[0] or 0
    cells = max(1, min(1 << 20, -(-count // cell_rows)))

    # cells of a source: by the first 20 bits of the shuffle key, in its order
    cell = F.floor(F.conv(F.substring("shuffled", 1, 5), 16, 10).cast("long") * F.lit(cells) / F.lit(1 << 20)).cast("int")
    # a null-safe join on a one-row-per-source table
    goal = goals.withColumnRenamed("source", "goal_source")
    dealt = rows.withColumn("cell", cell).join(goal, F.col("source").eqNullSafe(F.col("goal_source"))).drop("goal_source", "source")
    sums = dealt.groupBy("source_rank", "cell").agg(F.sum("size").alias("in_cell"))
    before = Window.partitionBy("source_rank").orderBy("cell")
    sums = sums.withColumn("base", F.sum("in_cell").over(before) - F.col("in_cell")).drop("in_cell")
    inside = Window.partitionBy("source_rank", "cell").orderBy("shuffled", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    sent = dealt.join(sums, ["source_rank", "cell"]).withColumn("sent", F.col("base") + F.sum("size").over(inside)).drop("base", "cell")
    sent = written(sent.select("doc_id", "size", "source_rank", "source_size", "target", "shuffled", "sent"))

    def finish(turn) -> F.Column:
        return (F.col("sent") + turn * F.col("source_size")) / F.when(F.col("size") > 0, F.col("target"))

    def place(turn) -> F.Column:
        """The global order of the mix: finish time, then source, then the source's own order."""
        return F.struct(finish(turn).alias("finish"), F.col("source_rank"), F.col("shuffled"), F.col("doc_id"), F.col("size"), turn.alias("turn"))

    turns = sent.where("size > 0").withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(cap - 1)))).withColumn("place", place(F.col("turn")))
    # ranges of finish time, about cell_rows rows each where the cut can be; all beyond 2 share the last one
    ranges = max(1, min(1 << 20, -(-count * cap // cell_rows)))
    turns = turns.withColumn("span", F.least(F.floor(F.col("place.finish") * F.lit(ranges) / 2), F.lit(ranges)).cast("int"))
    spans = turns.groupBy("span").agg(F.sum("size").alias("in_span"))
    spans = spans.withColumn("upto", F.sum("in_span").over(Window.partitionBy().orderBy("span")))
    budget = goals.agg(F.sum("target")).first()[0] or 0.0
    edge = spans.where(F.col("upto") > F.lit(budget)).agg(F.min("span").alias("span"), F.min_by(F.col("upto") - F.col("in_span"), "span").alias("before")).first()
    times = F.lit(cap)  # the budget covers everything
    if edge["span"] is not None:
        order = Window.partitionBy("span").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
        over = turns.where(F.col("span") == edge["span"]).select("place", (F.sum("size").over(order) + F.lit(edge["before"])).alias("upto"))
        first_left = over.where(F.col("upto") > F.lit(budget)).agg(F.min("place").alias("place")).first()["place"]
        bound = F.struct(*(F.lit(first_left[f]).cast(t).alias(f) for f, t in (("finish", "double"), ("source_rank", "int"), ("shuffled", "string"), ("doc_id", "long"), ("size", "long"), ("turn", "int"))))
        times = sum((F.when(place(F.lit(t)) < bound, 1).otherwise(0) for t in range(cap)), F.lit(0))
    times = F.when(F.col("size") > 0, times).otherwise(0)
    return sent.select("doc_id", "size", "source_size", "target", (times * F.col("size")).cast("long").alias("taken"), times.cast("int").alias("times"))


#: What ``mix`` returns on the table documents, in DuckDB's SQL.
MIX_SQL = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
k AS (SELECT *, md5(concat('%s:', coalesce(CAST(doc_id AS VARCHAR), 'null'), ':', CAST(size AS VARCHAR))) AS shuffled FROM d),
s AS (
  SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_rank FROM k GROUP BY source),
w AS (SELECT *, [5, 2, 1][CAST(source_rank %% 3 + 1 AS INTEGER)] AS weight FROM s),
c AS (SELECT *, source_size * 2 / weight AS cut, sum(source_size) OVER () * 150 / 100 AS amount FROM w),
l AS (
  SELECT *, (amount - (sum(source_size * 2) OVER o - source_size * 2)) / (sum(weight) OVER () - sum(weight) OVER o + weight) AS lv
  FROM c WINDOW o AS (ORDER BY cut, source_rank)),
m AS (SELECT *, max(CASE WHEN lv <= cut THEN lv END) OVER () AS level FROM l),
g AS (
  SELECT source, source_rank, source_size,
         CASE WHEN level IS NULL OR cut <= level THEN source_size * 2.0::DOUBLE ELSE weight * level END AS target FROM m),
t AS (
  SELECT k.doc_id, k.size, k.shuffled, g.source_rank, g.source_size, g.target,
         sum(size) OVER (PARTITION BY g.source_rank ORDER BY shuffled, doc_id, size ROWS UNBOUNDED PRECEDING) AS sent
  FROM k JOIN g ON k.source IS NOT DISTINCT FROM g.source),
f AS (SELECT *, (sent + turn * source_size) / CAST(target AS DOUBLE) AS finish FROM t, (VALUES (0), (1)) AS v(turn) WHERE size > 0),
u AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source_rank, shuffled, doc_id, size, turn ROWS UNBOUNDED PRECEDING) AS upto FROM f),
x AS (SELECT doc_id, shuffled, source_rank, size, count(*) AS times FROM u
      WHERE upto <= (SELECT sum(target) FROM g) GROUP BY ALL)
SELECT t.doc_id, CAST(t.size AS BIGINT) AS size, CAST(t.source_size AS BIGINT) AS source_size, t.target,
       CAST(coalesce(x.times, 0) * t.size AS BIGINT) AS taken, CAST(coalesce(x.times, 0) AS INTEGER) AS times
FROM t LEFT JOIN x ON t.doc_id IS NOT DISTINCT FROM x.doc_id AND t.shuffled = x.shuffled
  AND t.source_rank = x.source_rank AND t.size = x.size
""" % SEED
