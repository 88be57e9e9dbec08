"""The pages of the API queries, and what a reader makes of them, in one process: no server, no port."""

import json
import socket
from http.client import HTTPResponse
from pathlib import Path
from urllib.parse import parse_qs, urlsplit

import pyarrow as pa
import pytest
from pyspark.sql.types import StringType, StructField, StructType

from millrace.operators.slices import ranked
from millrace.sources import rest
from millrace.sources.page_store import TOGETHER, PageServer, write_pages
from millrace.workspace import shared_folder


def items(store, **q):
    return json.loads(store.answer({k: str(v) for k, v in q.items()}))["items"]


@pytest.fixture
def served(spark, monkeypatch):
    """1000 rows whose keys have gaps, in 200 pages; a reader's requests are answered in this process."""
    rows = spark.range(1000).selectExpr("id * 100003 AS id", "element_at(array('F', 'O', 'a\"b\\tc', 'é', '', NULL), CAST(id % 6 + 1 AS INT)) AS status", "CAST(id * 0.25 AS DECIMAL(18,2)) AS price")
    path = shared_folder(spark)
    store = PageServer(spark, path, write_pages(rows.repartition(7), path, "id", 5))

    def get(client, url):
        client.calls += 1
        return rest.parse(store.answer({k: v[0] for k, v in parse_qs(urlsplit(url).query).items()})), {}

    monkeypatch.setattr(rest.Client, "get", get)
    return store, [(i * 100003, ("F", "O", 'a"b\tc', "é", "", None)[i % 6], f"{i * 0.25:.2f}") for i in range(1000)]


def test_pages_are_full_and_lie_together(served):
    """a page has its rows whatever the keys are, and a folder has many pages."""
    store, want = served
    assert store.pages == 200
    got = [[(x["id"], x["status"], f"{x['price']:.2f}") for x in items(store, page=n)] for n in range(200)]
    assert got == [want[i : i + 5] for i in range(0, 1000, 5)]
    assert items(store, page=200) == items(store, page=10_000) == []
    folders = [p for p in Path(store.path.removeprefix("file://")).iterdir() if p.is_dir()]
    assert len(folders) == -(-200 // TOGETHER)


def test_few_groups_are_kept(served):
    store, _ = served
    for n in (*range(0, 200, 3), *range(199, 0, -7)):
        assert len(items(store, page=n)) == 5
    assert len(store.kept) <= -(-200 // TOGETHER)
    store.kept.clear()
    import millrace.sources.page_store as page_store

    for n in range(page_store.KEPT + 5):
        store._group(n)
    assert len(store.kept) == page_store.KEPT


@pytest.mark.parametrize("only", ["F", 'a"b\tc', "é", "", "nothing"])
def test_pages_are_narrowed_by_a_text(served, only):
    """what an item has is known without reading its JSON, NULL is not the empty text."""
    store, want = served
    got = [(x["id"], x["status"]) for n in range(200) for x in items(store, page=n, only=only)]
    assert got == [w[:2] for w in want if w[1] == only]
    assert store.calls == store.narrowed == 200


def test_a_table_without_rows_has_one_page(spark):
    path = shared_folder(spark)
    store = PageServer(spark, path, write_pages(spark.range(0).selectExpr("id", "'F' AS status"), path, "id", 5))
    assert store.pages == 1 and json.loads(store.answer({})) == {"pages": 1, "items": [], "next": None}


def test_ranks_are_exact(spark):
    rows = spark.createDataFrame([(k,) for k in [None, 5, 5, 5, -3, None, 8, 1 << 40]], "k long").repartition(3)
    got = sorted((r.r, r.k) for r in ranked(rows, "k", "r").collect())
    assert [r for r, _ in got] == list(range(8)) and [k for _, k in got] == [None, None, -3, 5, 5, 5, 8, 1 << 40]
    assert ranked(rows.where("false"), "k", "r").collect() == []


SCHEMA = StructType([StructField(n, StringType()) for n in ("id", "status", "price", "_api_calls")])


def taken(batches):
    batches = list(batches)
    assert batches and all(isinstance(b, pa.RecordBatch) for b in batches)
    return [tuple(r.values()) for b in batches for r in b.to_pylist()]


def test_a_cursor_gives_batches(served):
    """Spark gets a batch per page, not single rows; numbers are texts as they were written."""
    store, want = served
    reader = rest.RestReader(SCHEMA, {"base_url": "http://x", "pagination": "cursor_token", "next_cursor_path": "next", "records_path": "items"})
    got = taken(reader.read(reader.partitions()[0]))
    assert [r[:3] for r in got] == [(str(i), s, p) for i, s, p in want]
    assert [r[3] for r in got] == ["1", "0", "0", "0", "0"] * 200 and store.calls == 200


def test_numbered_pages_and_streams_give_batches(served):
    """the same in several tasks, and of a stream."""
    store, want = served
    options = {"base_url": "http://x", "records_path": "items", "initial_page": "0", "page_size": "1", "total_count_path": "pages"}
    reader = rest.RestReader(SCHEMA, options | {"total_pages_hint": "200"})
    assert [r[0] for p in reader.partitions() for r in taken(reader.read(p))] == [str(w[0]) for w in want]
    stream = rest.RestStream(SCHEMA, options)
    first, end = stream.initialOffset(), stream.latestOffset()
    assert [r[0] for p in stream.partitions(first, end) for r in taken(stream.read(p))] == [str(w[0]) for w in want]


def test_values_of_items(served):
    """Texts, numbers, nested values and items that are no objects."""
    reader = rest.RestReader(StructType([StructField(n, StringType()) for n in ("a", "b", "_api_calls")]), {"base_url": "x", "records_path": "d.i", "field.b": "b.c"})
    client = rest.Client({})
    client.calls = 2
    body = rest.parse('{"d":{"i":[7,null,{"a":1.50,"b":{"c":[1,{"x":true}]}},"s",{"a":null,"b":3},{"a":false,"b":{"c":"é"}}]}}'.encode())
    assert taken([reader.batch(body, client)]) == [("1.50", '[1.0,{"x":true}]', "2"), (None, None, "0"), ("false", "é", "0")]
    client.calls = 3
    assert reader.batch(rest.parse(b'{"d":{"i":[]}}'), client).num_rows == 0 and client.calls == 3


def asked(store, request):
    """What the server's handler says to a request that comes over a pair of connected sockets."""
    here, there = socket.socketpair()
    with here, there:
        here.sendall(request)
        store.handler()(there, ("", 0), None)
        there.shutdown(socket.SHUT_WR)
        got = HTTPResponse(here)
        got.begin()
        return got.status, json.loads(got.read())


def test_requests_and_posts(served, spark):
    """pages as the server sends them, narrowed or with a total, and what is posted to it."""
    store, want = served
    assert asked(store, b"GET /?page=3&page_size=5&only=F HTTP/1.0\r\n\r\n") == (200, {"pages": 200, "items": [{"id": w[0], "status": "F", "price": float(w[2])} for w in want[15:20] if w[1] == "F"], "next": "4"})
    assert asked(store, b"GET /?cursor=199 HTTP/1.0\r\n\r\n")[1]["next"] is None and (store.calls, store.narrowed) == (2, 1)
    store.posted = shared_folder(spark)
    assert asked(store, b"POST /orders HTTP/1.0\r\nIdempotency-Key: k1\r\nContent-Length: 10\r\n\r\n[{\"id\":3}]") == (200, {})
    assert [r.id for r in spark.read.schema("id long").json(store.posted).collect()] == [3]
