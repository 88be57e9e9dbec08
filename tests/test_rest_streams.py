"""APIs as streams, with filters in their requests, and as the target of a write."""

import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest

from millrace.sinks.rest import Api, RestRows, post_batches, refused_rows
from millrace.sources.rest import RestCursorStream, RestPages
from millrace.workspace import shared_folder


class Growing(BaseHTTPRequestHandler):
    items: list = []
    asked: list = []
    posted: list = []
    receipts: list = []

    def log_message(self, *a):
        pass

    def answer(self, code, body):
        data = json.dumps(body).encode()
        self.send_response(code)
        self.send_header("Content-Length", str(len(data)))
        self.end_headers()
        self.wfile.write(data)

    def do_GET(self):
        q = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
        Growing.asked.append(q)
        size = int(q.get("limit", q.get("page_size", 3)))
        at = int(q["offset"]) if "offset" in q else int(q.get("cursor", 0)) if "page" not in q else (int(q["page"]) - 1) * size
        found = [i for i in Growing.items if "kind" not in q or i["kind"] in q["kind"].split(",")]
        part = found[at : at + size]
        if "fields" in q:
            part = [{k: i[k] for k in q["fields"].split(",")} for i in part]
        self.answer(200, {"total": len(found), "items": part, "next_cursor": str(at + size) if at + size < len(found) else None})

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        if self.path == "/receipt":
            Growing.receipts.append(body)
        elif any(r["id"] == 13 for r in body):
            return self.answer(422, {"error": "no 13"})
        else:
            Growing.posted.extend(r["id"] for r in body)
        self.answer(200, {})


@pytest.fixture
def api(spark):
    Growing.items, Growing.asked, Growing.posted, Growing.receipts = [], [], [], []
    server = ThreadingHTTPServer(("127.0.0.1", 0), Growing)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    spark.dataSource.register(RestPages)
    spark.dataSource.register(RestRows)
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()
    server.server_close()


def grow(n):
    Growing.items = [{"id": i, "kind": "ab"[i % 2]} for i in range(n)]
    Growing.asked.clear()


def run(spark, api, out, state, **options):
    stream = spark.readStream.format("rest_pages").schema("id string, kind string").options(base_url=api, records_path="items", page_size="3", **options).load()
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return sorted(int(r.id) for r in spark.read.schema("id string, kind string").parquet(out).collect())


def test_offsets_are_rows(spark, api):
    """Every row once, whether its page was full or not, and no page of a finished batch again."""
    out, state = shared_folder(spark), shared_folder(spark)
    options = {"pagination": "offset_limit", "total_count_path": "total", "tasks": "2"}
    grow(7)
    assert run(spark, api, out, state, **options) == list(range(7))
    grow(7)
    assert run(spark, api, out, state, **options) == list(range(7))
    assert all(q["offset"] == "0" for q in Growing.asked)  # only the total was asked for
    grow(20)
    assert run(spark, api, out, state, **options) == list(range(20))
    pages = [(int(q["offset"]), int(q["limit"])) for q in Growing.asked if q["offset"] != "0"]
    assert sorted(set(pages)) == [(7, 3), (10, 3), (13, 3), (16, 3), (19, 1)]


def test_offsets_are_full_pages(spark, api):
    out, state = shared_folder(spark), shared_folder(spark)
    grow(8)
    assert run(spark, api, out, state, total_count_path="total") == list(range(6))
    grow(9)
    assert run(spark, api, out, state, total_count_path="total") == list(range(9))
    assert {q["page"] for q in Growing.asked} == {"1", "3"}  # the total, and the page that has become full


def test_cursor(spark, api):
    out, state = shared_folder(spark), shared_folder(spark)
    options = {"pagination": "cursor_token", "size_param": "limit"}
    for n in (4, 4, 5, 11):
        grow(n)
        assert run(spark, api, out, state, **options) == list(range(n))
    assert min(int(q.get("cursor", 0)) for q in Growing.asked) == 3  # pages before it were finished


def test_cursor_replays_a_batch(api):
    from pyspark.sql.types import StructType

    grow(8)
    stream = RestCursorStream(StructType.fromDDL("id string"), {"base_url": api, "pagination": "cursor_token", "records_path": "items", "pages_per_batch": "2"})
    first, middle = stream.read(stream.initialOffset())
    second, end = stream.read(middle)
    first, second = list(first), list(second)
    assert [int(r[0]) for r in first + second] == list(range(8))
    grow(12)
    assert list(stream.readBetweenOffsets(stream.initialOffset(), middle)) == first and list(stream.readBetweenOffsets(middle, end)) == second
    assert [int(r[0]) for r in stream.read(end)[0]] == [8, 9, 10, 11]


def test_streams_need_what_they_count(spark, api):
    with pytest.raises(Exception, match="total_count_path"):
        run(spark, api, shared_folder(spark), shared_folder(spark))
    with pytest.raises(Exception, match="a stream needs pagination"):
        run(spark, api, shared_folder(spark), shared_folder(spark), pagination="link_header")


def test_filters_go_with_requests(spark, api):
    grow(40)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        read = lambda **o: spark.read.format("rest_pages").schema("id string, kind string").options(base_url=api, records_path="items", page_size="5", total_count_path="total", columns_param="fields", **o).load()
        push = {"push.eq.kind": "kind", "push.in.kind": "kind"}
        got = read(**push).where("kind = 'a' AND id > '3'").collect()
        assert sorted(r.id for r in got) == sorted(str(i) for i in range(0, 40, 2) if str(i) > "3")
        narrowed = len(Growing.asked)
        assert all(q["kind"] == "a" and q["fields"] == "id,kind" for q in Growing.asked)
        Growing.asked.clear()
        assert read().where("kind = 'a' AND id > '3'").count() == len(got)
        assert len(Growing.asked) == 9 and narrowed == 5  # the total, and 8 or 4 pages
        Growing.asked.clear()
        assert read(**push).where("kind IN ('b', 'c')").count() == 20
        assert {q["kind"] for q in Growing.asked} == {"b,c"}
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")


def test_write(spark, api):
    df = spark.range(12).repartition(3)
    df.write.format("rest_rows").options(url=api, batch_size="5", receipt=f"{api}/receipt").mode("append").save()
    assert sorted(Growing.posted) == list(range(12))
    assert Growing.receipts == [{"state": "committed", "batches": 3, "rows": 12, "refused": 0, "error": ""}]


def test_write_is_aborted(spark, api):
    """A task whose batch is refused counts for nothing, and the write fails."""
    df = spark.range(20).repartitionByRange(2, "id")
    with pytest.raises(Exception, match="no 13"):
        df.write.format("rest_rows").options(url=api, batch_size="2", receipt=f"{api}/receipt").mode("append").save()
    assert Growing.receipts and Growing.receipts[-1]["state"] == "aborted" and Growing.receipts[-1]["refused"] == 0
    Growing.receipts.clear()
    df.write.format("rest_rows").options(url=api, batch_size="2", receipt=f"{api}/receipt", max_refused="2").mode("append").save()
    assert Growing.receipts == [{"state": "committed", "batches": 10, "rows": 20, "refused": 2, "error": Growing.receipts[0]["error"]}] and "422" in Growing.receipts[0]["error"]
    with pytest.raises(Exception, match="append"):
        df.write.format("rest_rows").options(url=api).mode("overwrite").save()


def test_receipts_are_one_a_batch(spark, api):
    rows = spark.range(10, 20).selectExpr("id", "concat('o', id % 2) AS _origin").coalesce(1)
    receipts = post_batches(rows, Api(api, batch_size=4))
    assert sorted((r.rows, r.accepted, len(r.refused)) for r in receipts.collect()) == [(2, True, 0), (4, False, 4), (4, True, 0)]
    assert sorted(json.loads(r.raw_payload)["id"] for r in refused_rows(receipts).collect()) == [10, 11, 12, 13]
    with pytest.raises(ValueError, match="method"):
        Api(api, method="GET")
