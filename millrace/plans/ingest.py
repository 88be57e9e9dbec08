"""The whole ingestion job: validate, split, publish, count, gate."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.incremental import Mark, next_mark, next_offset
from ..operators.metrics import footers, move_rejects, observed, origin_metrics, output_stats, throughput
from ..operators.quality import GateError, Gates, duplicates
from ..operators.validate import Rule, Run, validate
from ..schema import Schema
from ..sinks.files import with_lineage, write_audit, write_delimited, write_json_lines, write_parquet, write_quarantine, write_run_file
from ..sinks.rest import Api, post_batches, refused_rows
from ..sinks.table import commit_table, stage_table
from ..workspace import move, remove


@dataclass
class Report:
    total_read: int
    valid: int
    dlq: int
    origins: dict[str, dict[str, int]]
    stats: dict
    watermark: str | None
    null_counts: dict[str, int] = field(default_factory=dict)
    invalid_counts: dict[str, int] = field(default_factory=dict)
    custom: dict[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class Sink:
    """Where valid rows go: "parquet", "csv" or "json" files below the run's folder, a "table" of the
    catalog, or batches posted to a "rest" API. ``options`` are the arguments of the sink's writer."""

    kind: str = "parquet"
    options: Mapping[str, object] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.kind not in ("parquet", "csv", "json", "table", "rest"):
            raise ValueError(f"sink is {self.kind!r}, not parquet, csv, json, table or rest")


def _write_files(data: DataFrame, path: str, sink: Sink, checksum: bool) -> dict:
    """Write the files of a file sink and look at what is there."""
    seen = Observation()
    data = data.observe(seen, F.count(F.lit(1)).alias("rows"))
    {"parquet": write_parquet, "csv": write_delimited, "json": write_json_lines}[sink.kind](data, path, **sink.options)
    return output_stats(data.sparkSession, path, rows=None if sink.kind == "parquet" else seen.get["rows"], checksum=checksum)


def _refused(rows: DataFrame, run: Run) -> DataFrame:
    """Rows that a sink refused, as dead letters."""
    return rows.select("raw_payload", "error_message", F.lit(None).cast("string").alias("failed_column"), F.col("origin").alias("_source_file"), run.timestamp().alias("_failed_at"), F.col("origin").alias("_origin"))


def run_ingest(source: DataFrame, schema: Schema, out: str, rules: Sequence[Rule] = (), gates: Gates = Gates(), unique: Sequence[str] = (), sensitive: Sequence[str] = (), run: Run | None = None, schema_id: str = "", mark: Mark | None = None, offset: int | None = None, trim: bool = True, compression: str = "snappy", single_file: bool = False, custom: Mapping[str, Column] | None = None, sink: Sink | None = None, checksum: bool = True) -> Report:
    """Validate ``source`` and publish it below ``out``: data/, quarantine/dead_letters, quarantine/audit, metrics/.

    One tagged frame, persisted, feeds all outputs; the scan that fills it counts its rows, failures,
    nulls and API calls by the way. The source's rows are counted in the scan that
    feeds it, before validation. Files are written aside, counted, and renamed to data/ only if
    every row read was either written or quarantined; rows of a table are staged and committed under
    the run's execution id likewise, so a run that is started again adds nothing. A gate that does not
    hold, and any other failure, leaves an error file and raises; the quarantine is written by then, if
    the rows could be read, and no data. The mark is that of the Parquet files which were written, from
    their footers; of other sinks, that of the valid rows. Rows that a REST sink refuses become
    dead letters and count as such. ``checksum`` reads the files again for their digest. ``custom`` has aggregates over the valid rows, by the names
    under which they are reported. ``sink``: Parquet files by default.
    """
    began, run = time.monotonic(), run or Run()
    sink = sink or Sink("parquet", {"compression": compression, "single_file": single_file})
    spark, seen = source.sparkSession, Observation()
    checked = validate(source.observe(seen, F.count(F.lit(1)).alias("rows")), schema, rules, sensitive, run, schema_id, trim)
    checked.tagged, tallies = observed(checked.tagged, schema.names)
    checked.persist()

    def stop(reasons: list[str]) -> None:
        if reasons:
            raise GateError("; ".join(reasons))

    try:
        write_quarantine(checked.dlq, f"{out}/quarantine")
        counts, read = tallies.get, seen.get["rows"]
        total, dlq = counts["total"], counts["dlq"]
        write_audit(checked.audit, f"{out}/quarantine")
        reasons = gates.broken(read, total - dlq, dlq)
        if read != total:
            reasons.append(f"{read} rows were read and {total} validated")
        reasons += [f"rule {r.rule} on {r.column_name} is broken by {r.n} rows" for r in checked.broken("fail").collect()]
        reasons += [f"column {c} repeats values" for c in unique if not duplicates(checked.valid, [c]).isEmpty()]
        stop(reasons)
        data = with_lineage(checked.valid)
        origins = origin_metrics(checked.tagged)
        written = data.drop("_origin")
        if sink.kind == "rest":
            receipts = post_batches(data.select(*schema.names, "_origin"), Api(**sink.options))
            refused = refused_rows(receipts)
            origins = move_rejects(origins, refused.groupBy("origin").agg(F.count("*").alias("n")))
            write_quarantine(_refused(refused, run), f"{out}/quarantine", "append")
            accepted = receipts.where("accepted").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
            stats = {"rows": accepted, "files": 0, "bytes": 0}
            dlq = total - stats["rows"]
            stop(gates.broken(read, stats["rows"], dlq))
        elif sink.kind == "table":
            staged = stage_table(written, **sink.options, run_id=run.execution_id)
            stats = {"rows": staged.rows, "files": 0, "bytes": 0}
        else:
            aside = f"{out}/_aside/{uuid.uuid4().hex}"
            stats = _write_files(written, aside, sink, checksum)
        if read != stats["rows"] + dlq:
            stop([f"{read} rows were read, {stats['rows']} written and {dlq} quarantined"])
        watermark = None if offset is None else str(next_offset(offset, read))
        if mark is not None and sink.kind == "parquet":
            with footers(spark):
                watermark = next_mark(spark.read.parquet(aside), mark).text
        elif mark is not None:
            watermark = next_mark(checked.valid, mark).text
        if sink.kind == "table":
            commit_table(spark, staged)
        elif sink.kind != "rest":
            move(spark, aside, f"{out}/data")
            remove(spark, f"{out}/_aside")
        by_origin = {r["origin"]: {"total_read": r["total_read"], "valid": r["valid"], "dlq": r["dlq"]} for r in origins.collect()}
        nulls, invalid = ({k: counts[k] for k in (f"{what}_{n}" for n in schema.names)} for what in ("null_count", "invalid_value_count"))
        if "api_calls" in counts:
            stats |= {"api_calls": counts["api_calls"]}
        own = checked.valid.agg(*(c.alias(n) for n, c in custom.items())).first().asDict() if custom else {}
        report = Report(read, stats["rows"], dlq, by_origin, stats | throughput(read, stats["bytes"], time.monotonic() - began), watermark, nulls, invalid, own)
        write_run_file(spark, f"{out}/metrics/run", {"pipeline_id": run.pipeline_id, "run_id": run.execution_id, "total_records_read": read, "rows_written": stats["rows"], "dead_letter_count": dlq, "origin_metrics": by_origin, "watermark": watermark, **stats, **nulls, **invalid, "custom": own})
        return report
    except Exception as e:
        write_run_file(spark, f"{out}/metrics/error", {"error": str(e), "kind": type(e).__name__, "pipeline_id": run.pipeline_id, "run_id": run.execution_id})
        raise
    finally:
        checked.unpersist()
