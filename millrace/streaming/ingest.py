"""New files of a folder, ingested once each, as a micro-batch stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.validate import Rule, Run, validate
from ..runlog import RunLog
from ..schema import Schema
from ..sources.files import read_delimited, read_json


#: Files of a batch, unless bytes bound it.
MAX_FILES = 1_000


def batch_log(spark: SparkSession, out: str) -> RunLog:
    """The batches that are published below ``out``."""
    return RunLog(spark, f"{out}/log", "batches")


def ingest_new_files(
    spark: SparkSession, folder: str, schema: Schema, out: str, checkpoint: str, fmt: str = "csv", rules: Sequence[Rule] = (), sensitive: Sequence[str] = (), sep: str = ",", header: str = "auto", max_files: int = MAX_FILES, max_bytes: int = 0, log: RunLog | None = None
) -> StreamingQuery:
    """Start a run over the files that no run has seen, in batches; it ends by itself.

    A batch has ``max_files`` files at most, or with ``max_bytes`` as many as have so many bytes. The
    stream is one of file names; a batch reads its files as the batch sources do, so that only the
    first row of a file can be a header, and malformed JSON lines become dead letters.

    A batch writes folders of its own (batch=<id>), compares what it read with what it wrote, and
    puts an entry in the log: only then is it published. A batch that is replayed after a failure overwrites its
    folders, or has nothing to do if its entry is there. Read the rows with ``published_rows``.
    """
    log = log or batch_log(spark, out)
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    bound = ("maxBytesPerTrigger", max_bytes) if max_bytes else ("maxFilesPerTrigger", max_files)
    names = reader.option(*bound).load(folder).select("path")

    def publish(batch: DataFrame, batch_id: int) -> None:
        if log.get(batch_id + 1):
            return
        paths = sorted(r["path"] for r in batch.collect())  # as many as a batch may have
        if not paths:
            return
        rows = read_delimited(spark, paths, schema, sep, header) if fmt == "csv" else read_json(spark, paths, schema, on_malformed="quarantine")
        count = F.count(F.lit(1)).alias("rows")
        read, valid, dlq = Observation(), Observation(), Observation()
        checked = validate(rows.observe(read, count), schema, rules, sensitive, Run(execution_id=str(batch_id)), trim=fmt == "csv").persist()
        try:
            checked.valid.observe(valid, count).write.mode("overwrite").parquet(f"{out}/data/batch={batch_id}")
            checked.dlq.observe(dlq, count).write.mode("overwrite").json(f"{out}/dead_letters/batch={batch_id}")
            checked.audit.write.mode("overwrite").json(f"{out}/audit/batch={batch_id}")
            counts = {"total_read": read.get["rows"], "valid": valid.get["rows"], "dlq": dlq.get["rows"]}
        finally:
            checked.unpersist()
        if counts["total_read"] != counts["valid"] + counts["dlq"]:
            raise ValueError(f"batch {batch_id}: {counts['total_read']} rows were read, {counts['valid']} written and {counts['dlq']} quarantined")
        log.put(batch_id + 1, {"batch": batch_id, "files": paths, **counts})

    return names.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _published(df: DataFrame, log: RunLog) -> DataFrame:
    """Batches follow each other, so those up to the last entry are all published."""
    return df.where(F.col("batch") < log.last().version).drop("batch")


def published_rows(spark: SparkSession, out: str) -> DataFrame:
    """The valid rows of all published batches."""
    return _published(spark.read.parquet(f"{out}/data"), batch_log(spark, out))


def published_dead_letters(spark: SparkSession, out: str) -> DataFrame:
    schema = "raw_payload string, error_message string, failed_column string, _source_file string, _failed_at timestamp, _origin string, batch int"
    return _published(spark.read.schema(schema).json(f"{out}/dead_letters"), batch_log(spark, out))


def batches(spark: SparkSession, out: str) -> DataFrame:
    """(batch, files, total_read, valid, dlq) of all published batches."""
    rows = [(c["batch"], len(c["files"]), c["total_read"], c["valid"], c["dlq"]) for c in (e.content for e in batch_log(spark, out).entries())]
    return spark.createDataFrame(rows, "batch int, files int, total_read long, valid long, dlq long")


def dedup_stream(stream: DataFrame, keys: Sequence[str], time_column: str, delay: str) -> DataFrame:
    """Rows of a stream whose key was not seen within the delay: state is dropped with the watermark."""
    return stream.withWatermark(time_column, delay).dropDuplicatesWithinWatermark(list(keys))
