import gzip
import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from millrace.schema import Field, Schema
from millrace.sinks.files import write_delimited, write_parquet
from millrace.sinks.rest import post_rows
from millrace.sinks.table import write_table
from millrace.sources.documents import extract_records, flatten, to_record
from millrace.sources.files import SNAPPY_MAGIC, read_delimited, read_json
from millrace.sources.rest import RestPages
from millrace.streaming.ingest import ingest_new_files, published_rows
from millrace.workspace import shared_folder

TWO = Schema.of(Field("id", "int64"), Field("name"))


def pairs(df):
    return sorted((r.id or "", r.name or "") for r in df.collect())


def test_delimited_shapes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('ID,name\n1, x \n\n2\n3,"a,b",extra\n4,st"ray\n5,"say ""hi"""\n6,\n')
    got = pairs(read_delimited(spark, [str(tmp_path / "a.csv")], TWO))
    assert got == [("1", "x"), ("2", ""), ("3", "a,b"), ("4", 'st"ray'), ("5", 'say "hi"'), ("6", "")]
    (tmp_path / "b.csv").write_text("1,x\n2,y\n")
    assert pairs(read_delimited(spark, [str(tmp_path / "b.csv")], TWO)) == [("1", "x"), ("2", "y")]
    with pytest.raises(ValueError):
        read_delimited(spark, [str(tmp_path / "b.csv")], TWO, header="true")


def test_charsets_and_codecs(spark, tmp_path):
    (tmp_path / "l.csv.gz").write_bytes(gzip.compress("1;São Paulo\n".encode("latin-1")))
    assert pairs(read_delimited(spark, [str(tmp_path / "l.csv.gz")], TWO, sep=";", charset="latin1")) == [("1", "São Paulo")]
    (tmp_path / "w.csv").write_bytes("1,é\n2,ü\n".encode("utf-16-le"))
    assert pairs(read_delimited(spark, [str(tmp_path / "w.csv")], TWO, charset="utf-16le")) == [("1", "é"), ("2", "ü")]
    (tmp_path / "f.csv.sz").write_bytes(SNAPPY_MAGIC + b"rest")
    with pytest.raises(ValueError, match="framed snappy"):
        read_delimited(spark, [str(tmp_path / "f.csv.sz")], TWO)
    with pytest.raises(ValueError):
        read_delimited(spark, ["x"], TWO, charset="ebcdic")


def test_json(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id":9007199254740993,"name":{"x":1}}\n{"name":"n"}\n')
    assert pairs(read_json(spark, [str(tmp_path / "a.jsonl")], TWO)) == [("", "n"), ("9007199254740993", '{"x":1}')]
    (tmp_path / "b.jsonl").write_text('{"id":1,"name":"a"}\nbroken\n')
    rows = read_json(spark, [str(tmp_path / "b.jsonl")], TWO, on_malformed="quarantine").collect()
    assert sorted((r.id or "", r._corrupt_record or "") for r in rows) == [("", "broken"), ("1", "")]
    with pytest.raises(Exception):  # noqa: B017
        read_json(spark, [str(tmp_path / "b.jsonl")], TWO).collect()


def test_documents(spark):
    docs = spark.createDataFrame([('{"_id":{"$oid":"ab"},"name":{"f":1}}',), ('{"id":7}',)], "document string")
    assert pairs(to_record(docs, TWO)) == [("7", ""), ("ab", '{"f":1}')]
    body = spark.createDataFrame([('{"d":{"items":[{"id":9007199254740993,"n":{"m":"x"}},5,{"id":2}]}}',)], "body string")
    assert pairs(extract_records(body, TWO, "d.items", {"name": "n.m"})) == [("2", ""), ("9007199254740993", "x")]
    with pytest.raises(Exception, match="no array"):
        extract_records(body, TWO, "d.nothing").collect()
    assert flatten(spark.range(1).select(F.struct(F.struct(F.lit(1).alias("c")).alias("b")).alias("a"))).columns == ["a.b.c"]


def test_writers(spark):
    df = spark.createDataFrame([(1, None, 1e7), (2, "a,b", 0.1)], "id long, name string, x double")
    path = shared_folder(spark)
    write_delimited(df, path, line_sep="\r\n", single_file=True)
    lines = sorted(r.value for r in spark.read.option("lineSep", "\r\n").text(path).collect())
    assert lines == ["1,,10000000", '2,"a,b",0.1', "id,name,x"]
    with pytest.raises(ValueError):
        write_delimited(df, shared_folder(spark), compression="zstd")
    with pytest.raises(ValueError):
        write_parquet(df, shared_folder(spark), compression="lzo")
    with pytest.raises(ValueError):
        write_table(df, "", "t")


class Api(BaseHTTPRequestHandler):
    items = [{"id": i, "name": f"item-{i}"} for i in range(1, 8)]
    posted, calls, busy = [], [], 1

    def log_message(self, *a):
        pass

    def answer(self, code, body, **headers):
        data = json.dumps(body).encode()
        self.send_response(code)
        for k, v in headers.items():
            self.send_header(k.replace("_", "-"), v)
        self.send_header("Content-Length", str(len(data)))
        self.end_headers()
        self.wfile.write(data)

    def do_GET(self):
        u, q = urlparse(self.path), {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
        Api.calls.append((u.path, q, self.headers.get("Authorization")))
        size = 3
        if u.path == "/busy" and Api.busy:
            Api.busy -= 1
            return self.answer(429, {}, Retry_After="0")
        at = int(q.get("offset", 0)) if "offset" in q else (int(q.get("page", 1)) - 1) * size
        if "cursor" in q:
            at = int(q["cursor"])
        part, nxt = self.items[at : at + size], at + size
        link = {"Link": f'<{u.path}?page={nxt // size + 1}>; rel="next"'} if u.path == "/link" and nxt < len(self.items) else {}
        self.answer(200, {"total": len(self.items), "data": {"items": [*part, 5]}, "next": str(nxt) if nxt < len(self.items) else None}, **link)

    def do_POST(self):
        body = self.rfile.read(int(self.headers["Content-Length"]))
        if b"item-4" in body:
            return self.answer(422, {"error": "no"})
        Api.posted.append((json.loads(body), self.headers["Idempotency-Key"]))
        self.answer(200, {})


@pytest.fixture(scope="module")
def api():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Api)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


@pytest.mark.parametrize(
    "endpoint,options,partitions",
    [
        ("/p", {"pagination": "page_number", "page_size": "3", "total_count_path": "total"}, 3),
        ("/p", {"pagination": "offset_limit", "page_size": "3", "total_pages_hint": "3"}, 3),
        ("/p", {"pagination": "cursor_token", "next_cursor_path": "next"}, 1),
        ("/link", {"pagination": "link_header"}, 1),
        ("/busy", {"pagination": "page_number", "page_size": "3", "total_pages_hint": "3"}, 3),
    ],
)
def test_rest_source(spark, api, endpoint, options, partitions):
    spark.dataSource.register(RestPages)
    df = spark.read.format("rest_pages").schema("id string, name string").options(base_url=api, endpoint=endpoint, records_path="data.items", auth="bearer", token="t0k", **options).load()
    assert pairs(df) == [(str(i), f"item-{i}") for i in range(1, 8)]
    assert df.rdd.getNumPartitions() == partitions and Api.calls[-1][2] == "Bearer t0k"


def test_rest_page_limit_and_start(spark, api):
    spark.dataSource.register(RestPages)
    reader = lambda **o: spark.read.format("rest_pages").schema("id string, name string").options(base_url=api, endpoint="/p", records_path="data.items", **o).load()
    assert reader(pagination="cursor_token", next_cursor_path="next", max_pages_limit="1").count() == 3
    assert reader(pagination="offset_limit", page_size="3", total_count_path="total", start_offset="4").count() == 3


def test_rest_sink(spark, api):
    rows = spark.createDataFrame([(i, f"item-{i}", "f") for i in range(1, 7)], "id long, name string, _origin string").coalesce(1)
    got = post_rows(rows, api + "/in", batch_size=2, envelope="rows").collect()
    assert [r.accepted for r in got] == [True, True, False, False, True, True]
    assert all("422" in r.error_message for r in got if not r.accepted)
    assert Api.posted[0][0] == {"rows": [{"id": 1, "name": "item-1"}, {"id": 2, "name": "item-2"}]} and len(Api.posted[0][1]) == 64
    lost = post_rows(rows.limit(1), "http://127.0.0.1:1/", batch_size=1, timeout_s=1).collect()
    assert [r.accepted for r in lost] == [False] and "failed" in lost[0].error_message


def test_stream_reads_each_file_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    run = lambda: ingest_new_files(spark, str(tmp_path / "in"), TWO, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    (tmp_path / "in" / "a.csv").write_text("id,name\n1,x\nbad,y\n")
    run()
    run()
    (tmp_path / "in" / "b.csv").write_text("id,name\n2,z\n")
    run()
    assert sorted(r.id for r in published_rows(spark, str(tmp_path / "out")).collect()) == [1, 2]
    assert spark.read.json(str(tmp_path / "out" / "dead_letters")).count() == 1
