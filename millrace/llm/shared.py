"""What the operators share: the tables they read and the folder they may write to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import shared_folder

#: White space of the word definition used across the operators: space, tab, LF, VT, FF, CR.
WORD = "[^\\x20\\x09-\\x0D]+"
#: A key is hot if it has more than one in HOT_KEYS of all rows, or more than TASK_ROWS rows, which
#: is what a task should have of one key. Of hot keys there are fewer than MOST_HOT in any case.
HOT_KEYS, TASK_ROWS, MOST_HOT = 1_000, 10_000_000, 1_000_000
#: The same for rows that are joined with wide ones.
WIDE_HOT_KEYS, WIDE_TASK_ROWS = 200, 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """The same rows from a table in the shared folder: cuts lineage, survives lost executors."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hot_from(total: int, hot_keys: int = HOT_KEYS, task_rows: int = TASK_ROWS) -> float:
    """The number of rows above which a key is hot, of ``total`` rows."""
    return max(min(total / hot_keys, task_rows), total / MOST_HOT)


def joined(rows: DataFrame, keyed: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` with what ``keyed`` has for their key: one row per key, with the number ``n`` of
    rows that have it at least. Hot keys, of which there are fewer than MOST_HOT, are joined by
    broadcast, so that none of them fills one task; ``keyed`` should have a few numbers a row.
    ``rows`` is gone through twice and should be a table."""
    keyed = written(keyed)
    limit = hot_from(keyed.agg(F.sum("n")).first()[0] or 0)
    hot = F.broadcast(keyed.where(F.col("n") > limit))
    rest = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(keyed.where(F.col("n") <= limit), on)
    return rows.join(hot, on).unionByName(rest)


def dealt(rows: DataFrame, keyed: DataFrame, on: str, by: str, counted: DataFrame, hot_keys: int = WIDE_HOT_KEYS, task_rows: int = WIDE_TASK_ROWS) -> DataFrame:
    """``rows`` joined with ``keyed``, which may be wide and may have several rows for a key. Rows
    of a hot key are dealt by a hash of ``by`` into parts of bounded size, each of which meets its
    own copy of what ``keyed`` has for the key. ``counted`` is a table with the keys of ``rows``.
    Only hot keys and their numbers of parts are broadcast."""
    limit = hot_from(counted.count(), hot_keys, task_rows)
    parts = counted.groupBy(on).agg(F.count("*").alias("n")).where(F.col("n") > limit).select(on, F.ceil(F.col("n") / limit).cast("long").alias("parts"))
    parts, n_parts = F.broadcast(parts), F.coalesce("parts", F.lit(1).cast("long"))
    rows = rows.join(parts, on, "left").withColumn("part", F.pmod(F.xxhash64(by), n_parts)).drop("parts")
    keyed = keyed.join(parts, on, "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), n_parts - 1))).drop("parts")
    return rows.join(keyed, [on, "part"]).drop("part")


def two_columns(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text (null read as empty) under fixed names, so that no
    other column of the caller can clash."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
