"""Key ranges of about equal size, for reads in parallel."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bounds_query(query: str, column: str, batch_size: int) -> str:
    """SQL that a database runs to cut the rows of ``query`` into buckets of ``batch_size`` by rank."""
    return f"SELECT bucket_id, MIN({column}) AS lower_bound, MAX({column}) AS upper_bound, COUNT(*) AS row_count FROM (SELECT {column}, CEIL(ROW_NUMBER() OVER (ORDER BY {column}) / {batch_size}.0) AS bucket_id FROM ({query.strip()}) user_rows) ranked GROUP BY bucket_id ORDER BY bucket_id"


def bucket(key: Column, bounds: list, after: bool = False) -> Column:
    """The number of (sorted) bounds below the key, or with ``after`` of those not above it, by steps
    that halve: an expression of the same size for any number of bounds, few nodes a step as Spark
    interprets it."""
    if not bounds:
        return F.lit(0)
    table = F.lit(bounds)

    def step(n: Column, half: Column) -> Column:
        bound = F.get(table, n + half - 1)  # NULL behind the last
        return F.when(bound <= key if after else bound < key, n + half).otherwise(n)

    found = F.aggregate(F.lit([1 << i for i in reversed(range(len(bounds).bit_length()))]), F.lit(0), step)
    return F.when(key.isNull(), 0).otherwise(found)


def exact_buckets(df: DataFrame, column: str, batch_size: int) -> DataFrame:
    """(bucket_id, lower_bound, upper_bound, row_count) by exact rank.

    Ranks come without a window over all rows: keys are counted first, ranges of keys get
    their sums, and the rows before a range are added to the rank inside it. Rows of a key
    that cross a bucket's end count in both, as a row-by-row rank has it.
    """
    keys = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("k")).agg(F.count("*").alias("n"))
    parts = keys.sparkSession.conf.get("spark.sql.shuffle.partitions")
    fractions = [i / int(parts) for i in range(1, int(parts))]
    cuts = sorted(set(keys.agg(F.percentile_approx("k", fractions, 10_000)).first()[0] or [])) if fractions else []
    keys = keys.withColumn("part", bucket(F.col("k"), cuts))
    before = keys.groupBy("part").agg(F.sum("n").alias("rows"))
    before = before.withColumn("base", F.sum("rows").over(Window.partitionBy().orderBy("part")) - F.col("rows")).select("part", "base")  # one row per range
    upto = Window.partitionBy("part").orderBy("k")
    ranked = keys.join(F.broadcast(before), "part").withColumn("last", F.col("base") + F.sum("n").over(upto)).withColumn("first", F.col("last") - F.col("n") + 1)
    of_rank = lambda c: F.ceil(c / batch_size).cast("long")
    spread = ranked.withColumn("bucket_id", F.explode(F.sequence(of_rank(F.col("first")), of_rank(F.col("last")))))
    inside = F.least("last", F.col("bucket_id") * batch_size) - F.greatest("first", (F.col("bucket_id") - 1) * batch_size + 1) + 1
    return spread.groupBy("bucket_id").agg(F.min("k").alias("lower_bound"), F.max("k").alias("upper_bound"), F.sum(inside).alias("row_count"))


def ranked(df: DataFrame, column: str, rank: str) -> DataFrame:
    """The rows with their exact rank by a key, from 0, NULL first. As in ``exact_buckets`` there is no
    window over all rows: ranges of keys are counted first, and a rank inside a range goes on from
    what is before it. One row per range is on the driver."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fractions = [i / parts for i in range(1, parts)]
    cuts = sorted(set(df.agg(F.percentile_approx(column, fractions, 10_000)).first()[0] or [])) if fractions else []
    part = bucket(F.col(column), cuts)
    sizes = {r.part: r["count"] for r in df.groupBy(part.alias("part")).count().collect()}
    base = F.get(F.lit([sum(n for p, n in sizes.items() if p < i) for i in range(len(cuts) + 1)]).cast("array<bigint>"), F.col("_part"))
    at = F.row_number().over(Window.partitionBy("_part").orderBy(column))
    return df.withColumn("_part", part).withColumn(rank, at - 1 + base).drop("_part")


def approximate_bounds(df: DataFrame, column: str, slices: int) -> list:
    """The inner bounds of ``slices`` ranges of about equal size, by approximate percentiles: one pass, no sort."""
    if slices < 2:
        return []
    got = df.agg(F.percentile_approx(column, [i / slices for i in range(1, slices)], max(10_000, 20 * slices))).first()[0]
    return sorted(set(got or []))


def contiguous(buckets: DataFrame) -> DataFrame:
    """(slice_index, lower_bound, upper_bound, is_first, is_last): the upper bound of a slice is the
    next one's lower bound. One row per bucket, so the window is small. No bucket: one open slice."""
    order = Window.partitionBy().orderBy("bucket_id")
    nxt = F.lead("lower_bound").over(order)
    rows = buckets.sparkSession.range(1).select().join(F.broadcast(buckets), how="left")  # a row of NULLs if there is none
    return rows.select((F.row_number().over(order) - 1).alias("slice_index"), "lower_bound", F.coalesce(nxt, "upper_bound").alias("upper_bound"), (F.row_number().over(order) == 1).alias("is_first"), nxt.isNull().alias("is_last"))


@dataclass(frozen=True)
class Slice:
    index: int
    lower: object
    upper: object
    is_first: bool
    is_last: bool

    def predicate(self, column: str, literal) -> str | None:
        """SQL condition; the first slice is open below and takes NULL keys, the last is open above.
        Together the slices hold every row once. None: no condition."""
        if self.is_first and self.is_last:
            return None
        if self.is_first:
            return f"({column} < {literal(self.upper)} OR {column} IS NULL)"
        if self.is_last:
            return f"{column} >= {literal(self.lower)}"
        return f"{column} >= {literal(self.lower)} AND {column} < {literal(self.upper)}"


def collect_slices(slices: DataFrame) -> list[Slice]:
    """The slice table (one row per read task) on the driver. Slices that begin with the key with
    which the next one begins would be empty and are left out."""
    rows = slices.orderBy("slice_index").collect()
    rows = [r for i, r in enumerate(rows) if i == len(rows) - 1 or r.lower_bound != rows[i + 1].lower_bound]
    return [Slice(i, r.lower_bound, r.upper_bound, i == 0, i == len(rows) - 1) for i, r in enumerate(rows)]


def assign(column: Column, slices: list[Slice]) -> Column:
    """The index of the slice that a key falls in; NULL keys are in the first."""
    return bucket(column, [s.lower for s in slices[1:]], after=True)


def by_condition(df: DataFrame, column: str, slices: list[Slice]) -> DataFrame:
    """The rows of each slice with its slice_index, as a union of one read per slice has them, in one
    pass: bisection finds the slice of a key, and the conditions of it and of the two beside it are
    evaluated as SQL. The plan has the same size for any number of slices."""

    def condition(first: bool, last: bool) -> str:
        return Slice(0, "_lower", "_upper", first, last).predicate(f"`{column}`", str) or "true"

    kind = df.schema[column].dataType.simpleString()
    rows = [(s.index, s.lower, s.upper, s.is_first, s.is_last) for s in slices]
    table = df.sparkSession.createDataFrame(rows, f"slice_index int, _lower {kind}, _upper {kind}, _first boolean, _last boolean")
    near = F.sequence(F.greatest(F.col("_near") - 1, F.lit(0)), F.least(F.col("_near") + 1, F.lit(len(slices) - 1)))
    found = df.withColumn("_near", assign(F.col(f"`{column}`"), slices)).withColumn("slice_index", F.explode(near)).join(F.broadcast(table), "slice_index")
    held = found.where(f"CASE WHEN _first AND _last THEN {condition(True, True)} WHEN _first THEN {condition(True, False)} WHEN _last THEN {condition(False, True)} ELSE {condition(False, False)} END")
    return held.select("slice_index", *(F.col(f"`{c}`") for c in df.columns))


def objectid_seconds(oid: Column) -> Column:
    """The creation time that the first eight hexadecimal digits of an object id hold."""
    return F.conv(F.substring(oid, 1, 8), 16, 10).cast("bigint")


def objectid_slices(df: DataFrame, column: str, slices: int) -> DataFrame:
    """(slice_index, lower_bound, upper_bound, is_first, is_last): equal steps of time between the
    smallest and the largest id; the last one ends with the largest."""
    ends = df.agg(F.min(F.lower(column)).alias("lo"), F.max(F.lower(column)).alias("hi")).where("lo IS NOT NULL")
    ends = ends.withColumn("a", objectid_seconds(F.col("lo"))).withColumn("b", objectid_seconds(F.col("hi"))).withColumn("n", F.when(F.col("b") <= F.col("a"), 1).otherwise(slices))
    step = F.greatest(F.floor((F.col("b") - F.col("a")) / F.col("n")), F.lit(1))
    rows = ends.withColumn("step", step).withColumn("i", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))))
    at = lambda i: F.rpad(F.lower(F.lpad(F.hex(F.col("a") + i * F.col("step")), 8, "0")), 24, "0")
    first, last = F.col("i") == 0, F.col("i") == F.col("n") - 1
    return rows.select(F.col("i").alias("slice_index"), F.when(first, F.col("lo")).otherwise(at(F.col("i"))).alias("lower_bound"), F.when(last, F.col("hi")).otherwise(at(F.col("i") + 1)).alias("upper_bound"), first.alias("is_first"), last.alias("is_last"))


def rebalance(df: DataFrame, n: int) -> DataFrame:
    """Deal the rows out evenly, as after a source with few large partitions."""
    return df.repartition(n)


def sort_in_slices(df: DataFrame, column: str) -> DataFrame:
    return df.sortWithinPartitions(column)
