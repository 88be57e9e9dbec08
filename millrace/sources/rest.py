"""Paged HTTP APIs as a Python data source: ``spark.read.format("rest_pages").schema(...).options(...).load()``.

Numbered and offset pages are planned on the driver (from a hint, or a total that one probe
reads) and read in ``tasks`` runs of pages (default 8) at once, which share the rate limit; cursors
and links are followed inside one task. A column _api_calls gets the requests that a page took, on
the page's first row, and 0 on the others.

Options: base_url, endpoint, pagination (page_number, offset_limit, cursor_token, link_header),
page_param, size_param, page_size, initial_page, total_pages_hint, total_count_path, start_offset,
cursor_param, next_cursor_path, has_more_path, max_pages_limit, records_path, field.<column> (path in
an item), param.<name>, header.<name>, mark_param and mark_value, auth (bearer, api_key, basic), token,
api_key_name, api_key_in (header, query), username, password, rate_limit_rps, max_retries, timeout_s, tasks,
columns_param (gets the paths of the schema's columns, so that the API sends no others).

*Filters.* push.<eq|in|gt|ge|lt|le>.<column> names the query parameter that narrows a column, for an API that
compares as Spark compares texts. Spark's filters on that column then go with every request, the probe
too, and are evaluated again on what comes back. Set spark.sql.python.filterPushdown.enabled.

*Streams.* ``spark.readStream.format("rest_pages")`` reads what an API has got since the last batch. Offsets are
rows (offset_limit) or full pages (page_number) up to the total that total_count_path tells, read by
tasks; or a cursor (cursor_token), followed on the driver for pages_per_batch (default 100) pages a batch. A
stream that starts again from its checkpoint asks for no page of a finished batch.
"""

from __future__ import annotations

import base64
import json
import random
import re
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

#: Filters that can go with a request, by the names that options have for them.
PUSHED = {EqualTo: "eq", In: "in", GreaterThan: "gt", GreaterThanOrEqual: "ge", LessThan: "lt", LessThanOrEqual: "le"}
#: HTTP states worth another try.
TRANSIENT = {429, 500, 502, 503, 504}


@dataclass
class Page(InputPartition):
    index: int
    follow: bool = False
    pages: int = 1
    step: int = 1
    #: Rows of the last page, if it is cut.
    last: int = 0

    def __post_init__(self) -> None:
        super().__init__(self.index)


def dig(value: object, path: str) -> object:
    """The value at a dotted path, or None."""
    for part in filter(None, path.removeprefix("$").split(".")):
        value = value.get(part) if isinstance(value, dict) else None
    return value


def _is_key(path: str) -> bool:
    """Does a path name a field of the item itself?"""
    return bool(path) and "." not in path and not path.startswith("$")


class _Number(str):
    """A JSON number as it was written."""

    __slots__ = ()


_DECODER = json.JSONDecoder(parse_int=_Number, parse_float=_Number)


def _plain(value: object) -> object:
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    if isinstance(value, list):
        return [_plain(v) for v in value]
    return float(value) if isinstance(value, _Number) else value


def as_text(value: object) -> str | None:
    if value is None or isinstance(value, str):
        return value if value is None or type(value) is str else str(value)
    if isinstance(value, bool):
        return "true" if value else "false"
    return json.dumps(_plain(value), ensure_ascii=False, separators=(",", ":"))


def parse(body: bytes) -> object:
    return _DECODER.decode(body.decode(json.detect_encoding(body), "surrogatepass"))


class Client:
    """Requests with authentication, a rate limit, and retries with full jitter that heed Retry-After."""

    def __init__(self, o: dict[str, str], share: int = 1):
        self.o, self.gap, self.at = o, share / float(o["rate_limit_rps"]) if o.get("rate_limit_rps") else 0.0, 0.0
        self.calls = 0
        self.headers = {k[7:]: v for k, v in o.items() if k.startswith("header.")}
        auth = o.get("auth", "")
        if auth == "bearer":
            self.headers["Authorization"] = f"Bearer {o['token']}"
        elif auth == "basic":
            self.headers["Authorization"] = "Basic " + base64.b64encode(f"{o['username']}:{o['password']}".encode()).decode()
        elif auth == "api_key" and o.get("api_key_in", "header") == "header":
            self.headers[o.get("api_key_name", "X-API-Key")] = o["token"]
        elif auth not in ("", "none", "api_key"):
            raise ValueError(f"auth {auth!r} is not supported")

    def get(self, url: str) -> tuple[object, dict[str, str]]:
        tries = int(self.o.get("max_retries", 5)) + 1
        for n in range(tries):
            if (wait := self.at + self.gap - time.monotonic()) > 0:
                time.sleep(wait)
            self.at = time.monotonic()
            self.calls += 1
            try:
                with urllib.request.urlopen(urllib.request.Request(url, headers=self.headers), timeout=float(self.o.get("timeout_s", 30))) as r:
                    return parse(r.read()), {k.lower(): v for k, v in r.headers.items()}
            except urllib.error.HTTPError as e:
                if e.code not in TRANSIENT or n == tries - 1:
                    raise RuntimeError(f"GET {url}: HTTP {e.code}") from e
                after = e.headers.get("Retry-After", "")
                pause = float(after) if after.isdigit() else random.uniform(0, min(30, 0.1 * 2**n))
            except OSError as e:
                if n == tries - 1:
                    raise RuntimeError(f"GET {url}: {e}") from e
                pause = random.uniform(0, min(30, 0.1 * 2**n))
            time.sleep(pause)
        raise AssertionError


class _Pages:
    """The pages of an API: what is asked for, and the rows of an answer."""

    def __init__(self, schema: StructType, options: dict[str, str]):
        self.names, self.o = [f.name for f in schema.fields], dict(options)
        self.kind = self.o.get("pagination", "page_number")
        if self.kind not in ("page_number", "offset_limit", "cursor_token", "link_header"):
            raise ValueError(f"pagination {self.kind!r} is not supported")
        self.size = int(self.o.get("page_size", 100))
        self.paths = [(n, self.o.get(f"field.{n.lower()}", n)) for n in self.names]
        self.share = 1
        self.narrowed: dict[str, str] = {}

    def url(self, index: int, cursor: str | None = None, size: int = 0) -> str:
        o = self.o
        q = {k[6:]: v for k, v in o.items() if k.startswith("param.")}
        if o.get("mark_param") and o.get("mark_value", "").strip():
            q[o["mark_param"]] = o["mark_value"].strip()
        q |= self.narrowed
        if o.get("columns_param"):
            q[o["columns_param"]] = ",".join(o.get(f"field.{n.lower()}", n) for n in self.names if n != "_api_calls")
        if o.get("auth") == "api_key" and o.get("api_key_in") == "query":
            q[o.get("api_key_name", "api_key")] = o["token"]
        if self.kind in ("page_number", "offset_limit"):
            number = self.kind == "page_number"
            q[o.get("page_param", "page" if number else "offset")] = str(index)
            q[o.get("size_param", "page_size" if number else "limit")] = str(size or self.size)
        elif self.kind == "cursor_token":
            if cursor:
                q[o.get("cursor_param", "cursor")] = cursor
            if o.get("size_param"):
                q[o["size_param"]] = str(self.size)
        return o["base_url"] + o.get("endpoint", "") + ("?" + urllib.parse.urlencode(q) if q else "")

    def total(self) -> int:
        """The rows that the API has, by one request."""
        first = int(self.o.get("initial_page", 1)) if self.kind == "page_number" else int(self.o.get("start_offset", 0))
        return int(as_text(dig(Client(self.o).get(self.url(first))[0], self.o["total_count_path"])) or 0)

    def runs(self, first: int, pages: int, last: int = 0) -> list[InputPartition]:
        """Runs of neighbouring pages, one for each task; the last page may have fewer rows."""
        step = 1 if self.kind == "page_number" else self.size
        share = min(pages, int(self.o.get("tasks", 8)))
        cuts = [pages * i // share for i in range(share + 1)]
        return [Page(first + a * step, False, b - a, step, last if b == pages else 0) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def columns(self, body: object, client: Client) -> list[list[str | None]]:
        """The items of an answer, a list per column."""
        items = dig(body, self.o.get("records_path", ""))
        if not isinstance(items, list):
            raise ValueError(f"no array at {self.o.get('records_path') or 'the root'} of the response")
        items = [item for item in items if isinstance(item, dict)]
        out: list[list[str | None]] = []
        for name, path in self.paths:
            if name == "_api_calls":
                out.append([str(client.calls), *["0"] * (len(items) - 1)] if items else [])
            else:
                values = (item.get(path) for item in items) if _is_key(path) else (dig(item, path) for item in items)
                out.append([v if v is None or type(v) is str else as_text(v) for v in values])
        if items:
            client.calls = 0
        return out

    def rows(self, body: object, client: Client) -> Iterator[tuple]:
        yield from zip(*self.columns(body, client), strict=True)

    def batch(self, body: object, client: Client) -> pa.RecordBatch:
        """The same as Spark takes it without looking at each value."""
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in self.columns(body, client)], names=self.names)

    def read_run(self, page: Page, share: int) -> Iterator[pa.RecordBatch]:
        client = Client(self.o, share)
        for i in range(page.pages):
            size = page.last if i == page.pages - 1 else 0
            yield self.batch(client.get(self.url(page.index + i * page.step, size=size))[0], client)

    def after(self, url: str, body: object, headers: dict[str, str]) -> str | None:
        """What names the next page: a cursor, or the address that a header links to. None: there is no next page."""
        o = self.o
        if self.kind == "link_header":
            m = re.search(r'<([^>]*)>\s*;[^,]*rel="?next"?', headers.get("link", ""))
            return urllib.parse.urljoin(url, m[1]) if m else None
        more = dig(body, o["has_more_path"]) if o.get("has_more_path") else True
        return (as_text(dig(body, o.get("next_cursor_path", "next_cursor"))) or None) if more not in (False, None) else None


class RestReader(_Pages, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        o = self.o
        limit = int(o.get("max_pages_limit", 0)) or None
        if self.kind in ("cursor_token", "link_header"):
            return [Page(0, True)]
        number = self.kind == "page_number"
        first = int(o.get("initial_page", 1)) if number else int(o.get("start_offset", 0))
        pages = int(o.get("total_pages_hint", 0))
        if not pages and o.get("total_count_path"):
            pages = max(1, -(-(self.total() - (0 if number else first)) // self.size))
        pages = min(pages or 1, limit or pages or 1)
        self.share = min(pages, int(o.get("tasks", 8)))
        return self.runs(first, pages)

    def read(self, partition: Page) -> Iterator[pa.RecordBatch]:
        if not partition.follow:
            yield from self.read_run(partition, self.share)
            return
        client, url, left = Client(self.o), self.url(0), int(self.o.get("max_pages_limit", 0) or 1 << 62)
        while url and left:
            body, headers = client.get(url)
            yield self.batch(body, client)
            left -= 1
            found = self.after(url, body, headers)
            url = found if self.kind == "link_header" or not found else self.url(0, found)


class PushingReader(RestReader):
    """A reader whose requests carry Spark's filters. Spark takes it only where pushdown is switched on."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            kind = PUSHED.get(type(f))
            parameter = self.o.get(f"push.{kind}.{'.'.join(f.attribute).lower()}") if kind else None
            if parameter and parameter not in self.narrowed:
                self.narrowed[parameter] = ",".join(map(str, f.value)) if kind == "in" else str(f.value)
            yield f  # an API may send more than it was asked for


class RestStream(_Pages, DataSourceStreamReader):
    """What an API has got since the last batch, by its total: rows, or pages that are full."""

    def __init__(self, schema: StructType, options: dict[str, str]):
        super().__init__(schema, options)
        if not self.o.get("total_count_path"):
            raise ValueError("a stream of pages needs total_count_path")

    def initialOffset(self) -> dict:
        return {"next": int(self.o.get("initial_page", 1)) if self.kind == "page_number" else int(self.o.get("start_offset", 0))}

    def latestOffset(self) -> dict:
        first, total = self.initialOffset()["next"], self.total()
        return {"next": first + total // self.size if self.kind == "page_number" else max(first, total)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        n = end["next"] - start["next"]
        if n <= 0:
            return []
        return self.runs(start["next"], n) if self.kind == "page_number" else self.runs(start["next"], -(-n // self.size), n % self.size)

    def read(self, partition: Page) -> Iterator[pa.RecordBatch]:
        yield from self.read_run(partition, int(self.o.get("tasks", 8)))

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class RestCursorStream(_Pages, SimpleDataSourceStreamReader):
    """Pages after a cursor, a bounded number of them a batch. A page without a next one is asked for
    again until it has one, and rows that it had before are left out by their number."""

    def initialOffset(self) -> dict:
        return {"cursor": "", "seen": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        client, rows, at = Client(self.o), [], dict(start)
        for _ in range(int(self.o.get("pages_per_batch", 100))):
            url = self.url(0, at["cursor"] or None)
            body, headers = client.get(url)
            page = list(self.rows(body, client))
            rows += page[at["seen"] :]
            found = self.after(url, body, headers)
            if not found:
                at["seen"] = len(page)
                break
            at = {"cursor": found, "seen": 0}
        return iter(rows), at

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        """The same rows again, after a failure: from one cursor to the other."""
        client, at = Client(self.o), dict(start)
        while at != end:
            url = self.url(0, at["cursor"] or None)
            body, headers = client.get(url)
            page = list(self.rows(body, client))
            if at["cursor"] == end["cursor"]:
                yield from page[at["seen"] : end["seen"]]
                return
            yield from page[at["seen"] :]
            at = {"cursor": self.after(url, body, headers) or end["cursor"], "seen": 0}

    def commit(self, end: dict) -> None:
        pass


class RestPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rest_pages"

    def schema(self) -> str:
        raise ValueError("give the schema: all its columns are text")

    def reader(self, schema: StructType) -> DataSourceReader:
        pushes = any(k.startswith("push.") for k in self.options)
        return (PushingReader if pushes else RestReader)(schema, self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        if self.options.get("pagination", "page_number") in ("page_number", "offset_limit"):
            return RestStream(schema, self.options)
        return super().streamReader(schema)  # there is none: Spark asks for the simple one

    def simpleStreamReader(self, schema: StructType) -> SimpleDataSourceStreamReader:
        if self.options.get("pagination") != "cursor_token":
            raise ValueError("a stream needs pagination page_number, offset_limit or cursor_token")
        return RestCursorStream(schema, self.options)
