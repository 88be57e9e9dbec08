"""Rows posted to an HTTP API in batches; batches that it refuses come back as rows."""

from __future__ import annotations

import hashlib
import json
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..functions.render import json_row
from ..workspace import shared_folder

METHODS = ("POST", "PUT", "PATCH")


@dataclass(frozen=True)
class Api:
    """Where batches of rows go, and how.

    A batch is an array, or an object that holds it under ``envelope``; with a batch size of 1
    and no envelope, a bare object. HTTP 400 and above, or no answer, rejects the whole batch.
    The Idempotency-Key header is the digest of the body, for tasks that run again.
    """

    url: str
    batch_size: int = 100
    envelope: str = ""
    method: str = "POST"
    headers: Mapping[str, str] | None = None
    timeout_s: float = 30

    def __post_init__(self) -> None:
        if self.method not in METHODS:
            raise ValueError(f"method is {self.method!r}, not one of {METHODS}")
        if self.batch_size < 1:
            raise ValueError("a batch has a row at least")

    def post(self, items: Sequence[str]) -> tuple[str, str]:
        """(key, error) of a batch of JSON objects; no error: it is accepted."""
        body = "[" + ",".join(items) + "]"
        if self.envelope:
            body = "{" + json.dumps(self.envelope) + ":" + body + "}"
        elif self.batch_size == 1:
            body = items[0]
        data = body.encode()
        key = hashlib.sha256(data).hexdigest()
        request = urllib.request.Request(self.url, data, {"Content-Type": "application/json", **(self.headers or {}), "Idempotency-Key": key}, method=self.method)
        try:
            with urllib.request.urlopen(request, timeout=self.timeout_s):
                return key, ""
        except urllib.error.HTTPError as e:
            return key, f"API returned HTTP status {e.code}: {e.read(500).decode('utf-8', 'replace')}"
        except OSError as e:
            return key, f"HTTP {self.method} failed: {e}"


_RECEIPTS = "batch_key string, rows long, accepted boolean, error_message string, refused array<struct<origin:string,raw_payload:string>>"


def _posted(df: DataFrame, api: Api, origin: str, answer: Callable[[list[tuple[str, str]], str, str], pd.DataFrame], schema: str) -> DataFrame:
    """A table in the shared folder with the ``answer`` to each batch of (origin, object), its key and its error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list[tuple[str, str]] = []
        send = lambda rows: answer(rows, *api.post([r[1] for r in rows]))
        for frame in frames:
            rest += list(zip(frame["origin"], frame["item"], strict=True))
            while len(rest) >= api.batch_size:
                yield send(rest[: api.batch_size])
                rest = rest[api.batch_size :]
        if rest:
            yield send(rest)

    source = F.col(origin) if origin in df.columns else F.lit("default")
    body = df.drop(origin) if origin in df.columns else df
    path, spark = shared_folder(df.sparkSession), df.sparkSession
    answers = df.select(source.alias("origin"), json_row(body).alias("item")).mapInPandas(run, schema)
    answers.write.parquet(path)
    return spark.read.schema(answers.schema).parquet(path)


def post_batches(df: DataFrame, api: Api, origin: str = "_origin") -> DataFrame:
    """(batch_key, rows, accepted, error_message, refused): a receipt per batch; refused has the rows of one that was rejected.

    The rows are posted once, at once. The receipts are a table in the shared folder that only tasks which
    ended well add to, so a batch counts once however often a task ran.
    """

    def receipt(rows: list[tuple[str, str]], key: str, error: str) -> pd.DataFrame:
        refused = [{"origin": a, "raw_payload": b} for a, b in rows] if error else []
        return pd.DataFrame({"batch_key": [key], "rows": [len(rows)], "accepted": [not error], "error_message": [error or None], "refused": [refused]})

    return _posted(df, api, origin, receipt, _RECEIPTS)


def refused_rows(receipts: DataFrame) -> DataFrame:
    """(origin, raw_payload, error_message) of the rows of rejected batches."""
    return receipts.where("NOT accepted").select("error_message", F.inline("refused")).select("origin", "raw_payload", "error_message")


@dataclass
class Posted(WriterCommitMessage):
    """What a task has posted."""

    batches: int
    rows: int
    refused: int
    error: str


class RestWriter(DataSourceWriter):
    """Batches posted by the tasks of a write. A task that fails takes its numbers with it; the driver adds
    up those of tasks that ended well, and prints nothing until all have."""

    def __init__(self, schema: StructType, options: Mapping[str, str]):
        o = dict(options)
        headers = {k[7:]: v for k, v in o.items() if k.startswith("header.")}
        self.api = Api(o["url"], int(o.get("batch_size", 100)), o.get("envelope", ""), o.get("method", "POST"), headers, float(o.get("timeout_s", 30)))
        self.refusals, self.receipt = int(o.get("max_refused", 0)), o.get("receipt", "")
        self.names = [f.name for f in schema.fields]

    def write(self, iterator: Iterator[Row]) -> Posted:
        done = Posted(0, 0, 0, "")
        while items := [json.dumps(dict(zip(self.names, r, strict=True)), default=str, ensure_ascii=False, separators=(",", ":")) for r in islice(iterator, self.api.batch_size)]:
            _, error = self.api.post(items)
            done.batches += 1
            done.rows += len(items)
            if error:
                done.refused += len(items)
                done.error = error
                if done.refused > self.refusals:
                    raise RuntimeError(f"{done.refused} rows were refused: {error}")
        return done

    def _end(self, state: str, messages: list[Posted | None]) -> dict:
        known = [m for m in messages if m is not None]
        return {"state": state, "batches": sum(m.batches for m in known), "rows": sum(m.rows for m in known), "refused": sum(m.refused for m in known), "error": next((m.error for m in known if m.error), "")}

    def _tell(self, content: dict) -> None:
        if self.receipt:
            Api(self.receipt, 1).post([json.dumps(content)])

    def commit(self, messages: list[Posted | None]) -> None:
        end = self._end("committed", messages)
        if end["refused"] > self.refusals:
            raise RuntimeError(f"{end['refused']} rows were refused: {end['error']}")
        self._tell(end)

    def abort(self, messages: list[Posted | None]) -> None:
        self._tell(self._end("aborted", messages))


class RestRows(DataSource):
    """``df.write.format("rest_rows").options(url=..., ...).mode("append").save()``

    Options: url, batch_size, envelope, method, timeout_s, header.<name>; max_refused: rows of rejected
    batches that the write bears (0), beyond which it fails; receipt: an address that gets one object with the
    state (committed or aborted), batches, rows and refused of the tasks that ended well.
    Use ``post_batches`` where refused rows are to be kept.
    """

    @classmethod
    def name(cls) -> str:
        return "rest_rows"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("an API is appended to: use mode append")
        return RestWriter(schema, self.options)


def post_rows(df: DataFrame, url: str, origin: str = "_origin", **options) -> DataFrame:
    """(origin, accepted, raw_payload, error_message): one row per row of ``df``, written or rejected. ``options`` are those of ``Api``.

    The rows are posted once, at once, and the result is a table in the shared folder.
    """

    def each(rows: list[tuple[str, str]], key: str, error: str) -> pd.DataFrame:
        return pd.DataFrame({"origin": [r[0] for r in rows], "accepted": not error, "raw_payload": [r[1] for r in rows], "error_message": error or None})

    return _posted(df, Api(url, **options), origin, each, "origin string, accepted boolean, raw_payload string, error_message string")
