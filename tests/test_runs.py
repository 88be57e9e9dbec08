"""State that runs leave for each other: logs, incremental runs, stream batches, staged tables."""

import os
import re
import threading
import uuid

import pytest
from pyspark.errors import StreamingQueryException

from millrace.operators.incremental import Mark, newer, next_mark
from millrace.operators.metrics import footers, output_stats, parquet_rows
from millrace.operators.quality import GateError, Gates
from millrace.plans.incremental import last_mark, published_runs, run_history, run_incremental
from millrace.plans.ingest import Sink, run_ingest
from millrace.runlog import Conflict, Entry, RunLog
from millrace.schema import Field, Schema
from millrace.sinks.table import commit_table, stage_table, write_table
from millrace.stores import arrow_uri
from millrace.streaming.ingest import batch_log, batches, ingest_new_files, published_dead_letters, published_rows
from millrace.workspace import shared_folder

SCHEMA = Schema.of(Field("id", "int64", False), Field("name"))
MARK = Mark("id", "integer")


def grown(spark, n):
    rows = spark.range(1, n + 1).selectExpr("id", "concat('n', id) AS name")
    return lambda mark: newer(rows, mark).selectExpr("CAST(id AS STRING) AS id", "name")


class Killed(RunLog):
    def put(self, version, content):
        raise InterruptedError


def test_log(spark):
    log = RunLog(spark, shared_folder(spark), "job-1")
    assert log.last() == Entry(0) and log.get(1) is None and log.entries() == []
    log.put(1, {"x": "é"})
    with pytest.raises(Conflict):
        log.put(1, {"x": "other"})
    log.put(2, {"x": 2})
    assert log.entries() == [Entry(1, {"x": "é"}), Entry(2, {"x": 2})] and log.last().version == 2
    for name in ("", "..", "a/b", "a b"):
        with pytest.raises(ValueError, match="job name"):
            RunLog(spark, "/x", name)


def test_one_of_many_puts_wins(spark):
    log, won = RunLog(spark, shared_folder(spark), "race"), []

    def put(i):
        try:
            log.put(1, {"by": i})
            won.append(i)
        except Conflict:
            pass

    threads = [threading.Thread(target=put, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert won and log.last().content["by"] in won


def test_three_runs_one_killed(spark):
    out = shared_folder(spark)
    log = RunLog(spark, f"{out}/state", "job")
    assert run_incremental(log, grown(spark, 10), SCHEMA, f"{out}/runs", MARK).watermark == "10"
    with pytest.raises(InterruptedError):
        run_incremental(Killed(spark, f"{out}/state", "job"), grown(spark, 20), SCHEMA, f"{out}/runs", MARK)
    assert published_runs(log).count() == 10 and last_mark(log, MARK).text == "10"
    run_incremental(log, grown(spark, 25), SCHEMA, f"{out}/runs", MARK)
    report = run_incremental(log, grown(spark, 25), SCHEMA, f"{out}/runs", MARK)  # nothing new
    assert (report.total_read, log.last().version) == (0, 2)
    run_incremental(log, grown(spark, 30), SCHEMA, f"{out}/runs", MARK)
    got = published_runs(log, ["id"]).collect()
    assert sorted((r.id, r._version) for r in got) == [(i, 1 if i <= 10 else 2 if i <= 25 else 3) for i in range(1, 31)]
    assert [tuple(r) for r in run_history(spark, log).select("version", "from_mark", "mark", "total_read").collect()] == [(1, None, "10", 10), (2, "10", "25", 15), (3, "25", "30", 5)]
    with pytest.raises(ValueError, match="the job's mark"):
        last_mark(log, Mark("name", "string"))


def test_runs_from_the_same_version_conflict(spark):
    out = shared_folder(spark)
    log = RunLog(spark, f"{out}/state", "job")

    def read(mark):  # another run is faster
        run_incremental(log, grown(spark, 5), SCHEMA, f"{out}/runs", MARK)
        return grown(spark, 10)(mark)

    with pytest.raises(Conflict):
        run_incremental(log, read, SCHEMA, f"{out}/runs", MARK)
    assert published_runs(log).count() == 5


def test_incremental_runs_into_a_table(spark):
    """A run killed after its table commit is replaced by the next one, which sees more rows."""
    out, table = shared_folder(spark), f"t_{uuid.uuid4().hex}"
    sink = Sink("table", {"dataset": "runs_db", "table": table})
    state = f"{out}/state"
    run_incremental(RunLog(spark, state, "job"), grown(spark, 10), SCHEMA, out, MARK, sink=sink)
    with pytest.raises(InterruptedError):
        run_incremental(Killed(spark, state, "job"), grown(spark, 20), SCHEMA, out, MARK, sink=sink)
    run_incremental(RunLog(spark, state, "job"), grown(spark, 25), SCHEMA, out, MARK, sink=sink)
    assert sorted(r.id for r in spark.table(f"runs_db.{table}").collect()) == list(range(1, 26))
    spark.sql(f"DROP TABLE runs_db.{table}")


def test_failures_leave_an_error_file(spark):
    out = shared_folder(spark)
    with pytest.raises(GateError):
        run_ingest(grown(spark, 5)(MARK), SCHEMA, out, gates=Gates(row_count_min=10))
    assert "at least 10" in spark.read.json(f"{out}/metrics/error").first().error
    bad = spark.range(3).selectExpr("CAST(id AS STRING) AS id", "raise_error('lost') AS name")
    out = shared_folder(spark)
    with pytest.raises(Exception, match="lost"):
        run_ingest(bad, SCHEMA, out)
    assert "lost" in spark.read.json(f"{out}/metrics/error").first().error


def test_counts_and_marks_come_from_footers(spark):
    path = shared_folder(spark)
    spark.range(1, 1001).selectExpr("id", "date_add(DATE '2020-01-01', CAST(id AS INT)) AS d", "timestamp_seconds(id) AS t").repartition(3).write.parquet(path)
    with footers(spark):
        df = spark.read.parquet(path)
        plan = df.agg({"id": "max", "*": "count"})._jdf.queryExecution().toString()
        assert re.search(r"PushedAggregation: \[[^]]*MAX\(id\)", plan)
        marks = [next_mark(df, Mark(c, k)).text for c, k in (("id", "integer"), ("d", "date"), ("t", "timestamp"))]
    assert marks == [next_mark(spark.read.parquet(path), Mark(c, k)).text for c, k in (("id", "integer"), ("d", "date"), ("t", "timestamp"))]
    assert parquet_rows(spark, path) == 1000
    assert output_stats(spark, path, checksum=False)["checksum"] is None
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(50):
        bad = "x,bad\n" if i % 5 == 0 else ""
        (tmp_path / "in" / f"f{i:02d}.csv").write_text(f"id,name\n{2 * i},a\n{2 * i + 1},b\n{bad}")
    return tmp_path


def test_fifty_files_in_batches_of_eight(spark, folder):
    out = f"file://{folder}/out"

    class KilledOnce(RunLog):
        def put(self, version, content):
            if version == 4:
                raise InterruptedError
            return super().put(version, content)

    run = lambda log=None: ingest_new_files(spark, f"{folder}/in", SCHEMA, out, f"{folder}/state", max_files=8, log=log).awaitTermination()
    with pytest.raises(StreamingQueryException):
        run(KilledOnce(spark, f"{out}/log", "batches"))
    assert os.path.isdir(folder / "out/data/batch=3") and batches(spark, out).count() == 3
    assert published_rows(spark, out).count() == 48  # data of the fourth batch are written, but not published
    run()
    got = {r.batch: r for r in batches(spark, out).collect()}
    assert [got[i].files for i in range(7)] == [8] * 6 + [2]
    assert all(r.total_read == r.valid + r.dlq for r in got.values())
    assert (sum(r.valid for r in got.values()), sum(r.dlq for r in got.values())) == (100, 10)
    assert sorted(r.id for r in published_rows(spark, out).collect()) == list(range(100))
    assert published_dead_letters(spark, out).count() == 10
    files = [f for e in batch_log(spark, out).entries() for f in e.content["files"]]
    assert len(files) == len(set(files)) == 50
    run()  # nothing new
    assert batches(spark, out).count() == 7


def test_batches_bounded_by_bytes(spark, folder):
    size = sum(f.stat().st_size for f in (folder / "in").iterdir())
    out = f"file://{folder}/out"
    ingest_new_files(spark, f"{folder}/in", SCHEMA, out, f"{folder}/state", max_bytes=size // 4).awaitTermination()
    assert 4 <= batches(spark, out).count() <= 8 and published_rows(spark, out).count() == 100


def test_staged_table(spark):
    name = f"t_{uuid.uuid4().hex}"
    full, df = f"runs_db.{name}", spark.range(5).selectExpr("id", "'x' AS name")
    stage_table(df, "runs_db", name, run_id="a")
    assert spark.table(full).count() == 0
    for _ in range(2):
        commit_table(spark, stage_table(df, "runs_db", name, run_id="a"))
    assert spark.table(full).count() == 5
    with pytest.raises(ValueError, match="not empty"):
        commit_table(spark, stage_table(df, "runs_db", name, "empty", "b"))
    commit_table(spark, stage_table(df, "runs_db", name, "empty", "a"))  # the same run
    commit_table(spark, stage_table(df.select("name", "id"), "runs_db", name, run_id="odd id / of a run"))
    assert spark.table(full).count() == 10
    commit_table(spark, stage_table(df, "runs_db", name, "truncate", "c"))
    assert [r[0] for r in spark.table(full).select("_run_id").distinct().collect()] == ["c"]
    with pytest.raises(ValueError, match="has the columns"):
        stage_table(df.withColumnRenamed("name", "other"), "runs_db", name)
    spark.sql(f"DROP TABLE {full}")


def test_staged_into_a_table_without_runs(spark):
    name, df = f"t_{uuid.uuid4().hex}", spark.range(5)
    write_table(df, "runs_db", name)
    commit_table(spark, stage_table(df, "runs_db", name, run_id="a"))
    assert spark.table(f"runs_db.{name}").count() == 10
    spark.sql(f"DROP TABLE runs_db.{name}")


def test_addresses():
    assert arrow_uri("s3a://bucket/a b") == "s3://bucket/a%20b"
    assert arrow_uri("file:/x/y") == "file:///x/y"
    assert arrow_uri("hdfs://host:8020/x") == "hdfs://host:8020/x"
    assert arrow_uri("/x/y") == "file:///x/y"
