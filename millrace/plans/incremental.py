"""Runs that go on where the last one ended.

A run reads beyond the mark of the last entry in its job's log, publishes what it has read in a
folder of its own, and puts an entry with that folder and the new mark. The entry commits both at
once: a run that ends before it has left nothing that counts, and the next one reads the same rows again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import Mark
from ..operators.validate import Run
from ..runlog import RunLog
from ..schema import Schema
from .ingest import Report, Sink, run_ingest


def last_mark(log: RunLog, mark: Mark) -> Mark:
    """The mark of the last run, else the given one, where a job begins. A job keeps its column and kind."""
    last = log.last()
    if not last.version:
        return mark
    if (last.content["column"], last.content["kind"]) != (mark.column, mark.kind):
        raise ValueError(f"the job's mark is {last.content['column']} ({last.content['kind']}), not {mark.column} ({mark.kind})")
    return replace(mark, text=last.content["mark"])


def run_incremental(log: RunLog, read: Callable[[Mark], DataFrame], schema: Schema, out: str, mark: Mark, run: Run | None = None, sink: Sink | None = None, **options) -> Report:
    """One run of the job of ``log``: what ``read`` returns beyond the last mark, published as by ``run_ingest``.

    Of runs that begin from the same version one wins; the others raise ``Conflict``, and what they
    have written is not read. A run without rows puts no entry. Rows of a table sink are committed
    under the job's version, so the next run replaces those of a run that ended before its entry.
    """
    mark.check(schema)
    last = log.last()
    version = last.version + 1
    start = last_mark(log, mark)
    run = run or Run()
    if not run.execution_id:
        run = replace(run, execution_id=f"{log.folder.rpartition('/')[2]}-{version}")
    folder = f"{out}/run={version}-{uuid.uuid4().hex[:12]}"
    report = run_ingest(read(start), schema, folder, run=run, mark=start, sink=sink, **options)
    if report.total_read:
        content = {"column": mark.column, "kind": mark.kind, "mark": report.watermark, "from": start.text, "folder": folder, "run_id": run.execution_id}
        log.put(version, content | {"total_read": report.total_read, "valid": report.valid, "dlq": report.dlq})
    return report


def published_runs(log: RunLog, columns: Sequence[str] | None = None) -> DataFrame:
    """The Parquet rows of all runs that have an entry, with the version that published them as _version."""
    entries = log.entries()
    if not entries:
        raise ValueError(f"{log.folder} has no run yet")
    folders = [e.content["folder"] for e in entries]
    rows = log.spark.read.parquet(*(f"{f}/data" for f in folders))
    version = F.regexp_extract(F.col("_metadata.file_path"), r"/run=([0-9]+)-[0-9a-f]{12}/data/", 1).cast("int")
    return rows.select(*(columns or rows.columns), version.alias("_version"))


def run_history(spark: SparkSession, log: RunLog) -> DataFrame:
    """(version, from_mark, mark, total_read, valid, dlq, run_id), a row per run."""
    rows = [(e.version, e.content["from"], e.content["mark"], e.content["total_read"], e.content["valid"], e.content["dlq"], e.content["run_id"]) for e in log.entries()]
    return spark.createDataFrame(rows, "version int, from_mark string, mark string, total_read long, valid long, dlq long, run_id string")
