"""Counts that prove that every row read was written or quarantined."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..stores import open_store

#: Bytes of a file that are hashed at once.
CHUNK = 8 << 20


def origin_metrics(tagged: DataFrame) -> DataFrame:
    """(origin, total_read, valid, dlq): a hash aggregate that combines before the shuffle."""
    failed = F.col("_failure").isNotNull()
    return tagged.groupBy(F.col("_origin").alias("origin")).agg(F.count("*").alias("total_read"), F.count_if(~failed).alias("valid"), F.count_if(failed).alias("dlq"))


def move_rejects(origins: DataFrame, rejects: DataFrame) -> DataFrame:
    """Rows that a sink rejected, (origin, n), move from valid to dlq."""
    moved = origins.join(rejects.select("origin", "n"), "origin", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return moved.select("origin", "total_read", (F.col("valid") - F.col("n")).alias("valid"), (F.col("dlq") + F.col("n")).alias("dlq"))


def summary(origins: DataFrame, pipeline_id: str = "", run_id: str = "") -> DataFrame:
    """One row: totals and the map of origins. There are as many entries as origins (files or sources)."""
    entry = F.struct("origin", F.struct("total_read", "valid", "dlq"))
    return origins.agg(
        F.lit(pipeline_id).alias("pipeline_id"),
        F.lit(run_id).alias("run_id"),
        F.coalesce(F.sum("total_read"), F.lit(0)).alias("total_records_read"),
        F.coalesce(F.sum("valid"), F.lit(0)).alias("rows_written"),
        F.coalesce(F.sum("dlq"), F.lit(0)).alias("dead_letter_count"),
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("origin_metrics"),
    )


def source_counts(raw: DataFrame, origin: str = "_origin") -> DataFrame:
    """(origin, source_rows), counted on the source itself, not on what validation made of it."""
    return raw.groupBy(F.col(origin).alias("origin")).agg(F.count("*").alias("source_rows"))


def conservation(origins: DataFrame, sources: DataFrame) -> DataFrame:
    """(origin, source_rows, valid, dlq, conserved), origins that only one side has included."""
    both = sources.join(origins.select("origin", "valid", "dlq"), "origin", "full")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return both.select("origin", zero("source_rows").alias("source_rows"), zero("valid").alias("valid"), zero("dlq").alias("dlq"), (zero("source_rows") == zero("valid") + zero("dlq")).alias("conserved"))


def lost_rows(raw: DataFrame, outputs: Sequence[DataFrame], key: str) -> DataFrame:
    """Keys of source rows that are in no output."""
    kept = outputs[0].select(key)
    for o in outputs[1:]:
        kept = kept.union(o.select(key))
    return raw.join(kept, key, "left_anti").select(key)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(metric, n): NULLs per column, as null_count_<column>."""
    counts = [F.struct(F.lit(f"null_count_{c}").alias("metric"), F.count_if(F.col(f"`{c}`").isNull()).alias("n")) for c in columns]
    return df.agg(F.array(*counts).alias("m")).select(F.inline("m"))


def invalid_counts(tagged: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(metric, n): first failures per column, as invalid_value_count_<column>."""
    counts = [F.struct(F.lit(f"invalid_value_count_{c}").alias("metric"), F.count_if(F.col("_failed_column") == c).alias("n")) for c in columns]
    return tagged.agg(F.array(*counts).alias("m")).select(F.inline("m"))


def _digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of files, read in chunks."""
    for frame in frames:
        out = []
        for path in frame["path"]:
            fs, name = open_store(path)
            digest = hashlib.sha256()
            with fs.open_input_stream(name, compression=None) as stream:
                while chunk := stream.read(CHUNK):
                    digest.update(chunk)
            out.append(digest.hexdigest())
        yield pd.DataFrame({"length": frame["length"], "digest": out})


def observed(tagged: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, Observation]:
    """The tagged rows, and what the first action over all of them will have counted: total, dlq,
    null_count_<column> of the valid rows and invalid_value_count_<column>, for each column; api_calls
    where the source tells them. No pass of its own is made."""
    seen = Observation()
    failed = F.col("_failure").isNotNull()
    counts = [F.count(F.lit(1)).alias("total"), F.count_if(failed).alias("dlq")]
    counts += [F.count_if(F.col(f"_v_{i}").isNull() & ~failed).alias(f"null_count_{c}") for i, c in enumerate(columns)]
    counts += [F.count_if(F.col("_failed_column") == c).alias(f"invalid_value_count_{c}") for c in columns]
    if "_calls" in tagged.columns:
        counts.append(F.coalesce(F.sum("_calls"), F.lit(0)).alias("api_calls"))
    return tagged.observe(seen, *counts), seen


@contextmanager
def footers(spark: SparkSession) -> Iterator[None]:
    """Counts and largest values of Parquet files, asked for in here, are answered by their footers
    where those can: for rows, numbers and dates. No row is read then."""
    wanted = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def parquet_rows(spark: SparkSession, path: str) -> int:
    """Rows of a folder of Parquet files, by their footers."""
    with footers(spark):
        return spark.read.parquet(path).agg(F.count(F.lit(1))).first()[0] or 0  # no footer, no count


def output_stats(spark, path: str, fmt: str = "parquet", rows: int | None = None, checksum: bool = True) -> dict:
    """Rows, bytes, files and one digest of a published folder, from what is really there.

    The digest is the SHA-256 of the files' own ones in their order, so it does not depend on
    names that a run makes up. Files are hashed in tasks, a chunk at a time. ``rows``: their
    number where it is known and counting the files would not tell it. Without
    ``checksum`` no file is opened for its bytes.
    """
    if rows is None:
        rows = parquet_rows(spark, path) if fmt == "parquet" else spark.read.format(fmt).load(path).count()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where(~F.col("path").rlike(r"/[._][^/]*$")).select("path", "length")
    if not checksum:
        got = files.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
        return {"rows": rows, "files": got["files"], "bytes": got["bytes"], "checksum": None}
    each = files.repartition("path").mapInPandas(_digests, "length long, digest string")
    got = each.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.sha2(F.array_join(F.array_sort(F.collect_list("digest")), ""), 256).alias("checksum")).first()
    return {"rows": rows, "files": got["files"], "bytes": got["bytes"], "checksum": got["checksum"]}


def file_rows(spark, path: str, fmt: str = "parquet") -> DataFrame:
    """(file, rows) of a published folder."""
    return spark.read.format(fmt).load(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))


def throughput(rows: int, nbytes: int, seconds: float) -> dict:
    seconds = max(seconds, 1e-9)
    return {"execution_duration_ms": round(seconds * 1000), "records_per_second": rows / seconds, "throughput_mb_per_second": nbytes / 1e6 / seconds}
