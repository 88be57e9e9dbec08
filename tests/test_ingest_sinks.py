"""Whole jobs into every sink; what a broken job leaves behind; a database read by slices."""

import json
import threading
import uuid
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from millrace.operators.incremental import Mark
from millrace.operators.metrics import output_stats
from millrace.operators.quality import GateError, Gates
from millrace.plans.ingest import Sink, run_ingest
from millrace.schema import Field, Schema
from millrace.sources.jdbc import read_slices
from millrace.sources.rest import RestPages, RestReader
from millrace.workspace import shared_folder

SCHEMA = Schema.of(Field("id", "int64", False), Field("name"))


class Api(BaseHTTPRequestHandler):
    posted: list = []

    def log_message(self, *a):
        pass

    def do_POST(self):
        rows = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        code = 422 if any(r["id"] % 7 == 0 for r in rows) else 200
        if code == 200:
            Api.posted.extend(r["id"] for r in rows)
        self.send_response(code)
        self.send_header("Content-Length", "0")
        self.end_headers()

    def do_GET(self):
        data = json.dumps([{"id": i} for i in range(2)]).encode()
        self.send_response(200)
        self.send_header("Content-Length", str(len(data)))
        self.end_headers()
        self.wfile.write(data)


@pytest.fixture(scope="module")
def api():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Api)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def source(spark, n=40):
    rows = [(str(i), f"n{i}", f"file-{i % 2}") for i in range(1, n + 1)] + [("bad", "x", "file-0")]
    return spark.createDataFrame(rows, "id string, name string, _source_file string")


def test_rest_sink_moves_rejects_to_the_dead_letters(spark, api):
    out = shared_folder(spark)
    r = run_ingest(source(spark).coalesce(1), SCHEMA, out, sink=Sink("rest", {"url": api, "batch_size": 2}))
    # pairs (1, 2), (3, 4)...: those with a multiple of 7 are refused
    refused = {i for a in range(1, 41, 2) for i in (a, a + 1) if a % 7 == 0 or (a + 1) % 7 == 0}
    assert sorted(Api.posted) == sorted(set(range(1, 41)) - refused), "each row was posted once"
    assert (r.total_read, r.valid, r.dlq) == (41, 40 - len(refused), 1 + len(refused))
    assert sum(o["dlq"] for o in r.origins.values()) == r.dlq and sum(o["valid"] for o in r.origins.values()) == r.valid
    letters = spark.read.json(f"{out}/quarantine/dead_letters")
    assert letters.count() == r.dlq and letters.where("error_message LIKE '%422%'").count() == len(refused)
    with pytest.raises(GateError):
        run_ingest(source(spark).coalesce(1), SCHEMA, shared_folder(spark), gates=Gates(max_error_percentage=5), sink=Sink("rest", {"url": api, "batch_size": 2}))


@pytest.mark.parametrize("kind,options", [("parquet", {"single_file": True}), ("csv", {"compression": "gzip"}), ("json", {})])
def test_file_sinks(spark, kind, options):
    out = shared_folder(spark)
    r = run_ingest(source(spark), SCHEMA, out, sink=Sink(kind, options))
    back = spark.read.option("header", True).format(kind).load(f"{out}/data")
    assert (r.total_read, r.valid, r.dlq) == (41, 40, 1) and back.count() == 40 == r.stats["rows"]
    assert r.stats["files"] == (1 if options.get("single_file") else r.stats["files"]) > 0 and len(r.stats["checksum"]) == 64
    with pytest.raises(ValueError):
        Sink("carrier pigeon")


def test_table_sink(spark):
    name = f"t{uuid.uuid4().hex}"
    for n in (40, 80):
        r = run_ingest(source(spark), SCHEMA, shared_folder(spark), sink=Sink("table", {"dataset": "sink_tests", "table": name}))
        assert r.valid == 40 and spark.table(f"sink_tests.{name}").count() == n
    spark.sql(f"DROP TABLE sink_tests.{name}")


def test_broken_runs_leave_an_error_and_can_run_again(spark):
    out = shared_folder(spark)
    for _ in range(2):
        with pytest.raises(GateError):
            run_ingest(source(spark), SCHEMA, out, gates=Gates(max_error_percentage=1))
        assert "quarantined" in spark.read.text(f"{out}/metrics/error").first()[0]
        assert spark.read.json(f"{out}/quarantine/dead_letters").count() == 1
    assert run_ingest(source(spark), SCHEMA, out).valid == 40
    assert spark.read.json(f"{out}/quarantine/dead_letters").count() == 1 and spark.read.parquet(f"{out}/data").count() == 40
    with pytest.raises(ValueError, match="there already"):
        run_ingest(source(spark), SCHEMA, out)


def test_files_are_hashed_in_chunks(spark, tmp_path, monkeypatch):
    import hashlib

    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "part x.txt").write_bytes(b"line\n" * 5_000_000)
    one = hashlib.sha256((tmp_path / "d" / "part x.txt").read_bytes()).hexdigest()
    stats = output_stats(spark, str(tmp_path / "d"), "text")
    assert stats["checksum"] == hashlib.sha256(one.encode()).hexdigest() and stats["bytes"] == 25_000_000


def test_pages_are_read_in_runs_and_counted(spark, api):
    spark.dataSource.register(RestPages)
    df = spark.read.format("rest_pages").schema("id string, _api_calls string").options(base_url=api, total_pages_hint="30", tasks="4").load()
    rows = df.collect()
    assert df.rdd.getNumPartitions() == 4 and len(rows) == 60 and sum(int(r._api_calls) for r in rows) == 30
    reader = RestReader(df.schema, {"base_url": api, "total_pages_hint": "30", "tasks": "4"})
    assert [p.pages for p in reader.partitions()] == [7, 8, 7, 8] and reader.share == 4


def test_database_by_slices(spark):
    url = f"jdbc:derby:memory:m{uuid.uuid4().hex};create=true"
    rows = spark.range(500).selectExpr("id AS K", "concat('s', id % 3) AS ST", "CASE WHEN id % 50 = 0 THEN NULL ELSE id END AS SLICE_KEY")
    rows.coalesce(1).write.option("createTableColumnTypes", "ST VARCHAR(8)").jdbc(url, "SRC")
    got = read_slices(spark, url, "SELECT K, ST, SLICE_KEY FROM SRC", "SLICE_KEY", 100, bounds="spark", mark=Mark("K", "integer", "100"))
    assert got.rdd.getNumPartitions() == 4 and sorted(r.K for r in got.collect()) == list(range(101, 500))
