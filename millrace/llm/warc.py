"""WARC archives: write pages, normalise whole-file gzip streams, read back by offset.

Crawlers at times leave an archive as one gzip stream, out of which no record can be read
alone. The normaliser inflates such a file once, rewrites every record as a gzip member of
its own and writes a sidecar index with the offset of each. All three steps run as tasks
over archives, hold one record at a time in memory, and name their files in the table they
return: a task that is run again writes new files, and only those of the run that ended
well are ever referred to.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..stores import open_store
from ..workspace import shared_folder
from .shared import joined, written

#: Uncompressed bytes after which a writer starts the next archive.
ARCHIVE_BYTES = 48 << 20
CHUNK = 1 << 20
LEVEL = 6
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def record_id(page_id: int | None, digest: str, nth: int = 1) -> str:
    """A name of its own for each record: page, payload, and a number if both repeat. A page
    without an id is nobody's reference, and gets a random one."""
    return f"<urn:page:{page_id}:{digest}{f':{nth}' if nth > 1 else ''}>" if page_id is not None else f"<urn:page::{uuid.uuid4().hex}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, nth: int = 1) -> bytes:
    """One WARC record; a revisit has the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, digest, nth)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(refers_to, digest)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_store(folder)
        fs.create_dir(base, recursive=True)
        name, out, packer, size, made = "", None, None, 0, []

        def close() -> None:
            out.write(packer.flush())
            out.close()
            made.append(f"{folder}/{name}")

        for batch in batches:
            for page_id, url, payload, digest, refers_to, nth in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to", "nth")), strict=True):
                if out is None:
                    name, size = f"{uuid.uuid4().hex}.warc.gz", 0
                    out, packer = fs.open_output_stream(f"{base}/{name}", compression=None), zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                record = record_bytes(page_id.as_py(), url.as_py(), payload.as_py(), base64.b32encode(bytes.fromhex(digest.as_py())).decode(), refers_to.as_py(), nth.as_py())
                out.write(packer.compress(record))
                size += len(record)
                if size >= ARCHIVE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(made, pa.string())], ["archive"])

    return run, "archive string"


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write a record per page into whole-stream gzip archives; returns their addresses (archive).

    Of records with equal payloads of at least ``min_bytes`` bytes the one with the smallest id
    is a response and the others revisit it. No two records have the same id.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    ids = written(rows.where((F.length("payload") >= min_bytes) & F.col("page_id").isNotNull()).select("page_id", "digest"))
    first = ids.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    again = joined(ids, first, ["digest"]).drop("n").where("page_id <> refers_to").distinct()
    # rows alike in id and payload are told apart by a number; those without an id stay where they are
    alike = Window.partitionBy("page_id", "digest").orderBy("url")
    data = ["page_id", "url", "payload", "digest"]
    named = rows.where("page_id is not null").join(again, ["page_id", "digest"], "left").select(*data, "refers_to", F.row_number().over(alike).alias("nth"))
    unnamed = rows.where("page_id is null").select(*data, F.lit(None).cast("long").alias("refers_to"), F.lit(1).alias("nth"))
    run, schema = _write(folder)
    return written(named.union(unnamed).mapInArrow(run, schema))


def inflated(stream, where: str) -> Iterator[bytes]:
    """The bytes of a gzip file, one member or many, in chunks of at most CHUNK bytes however
    well they are packed. Zeros after a member, with which crawlers fill up files, are no member."""
    unpack = zlib.decompressobj(31)
    fed = False
    try:
        while data := stream.read(CHUNK):
            while data if fed else (data := data.lstrip(b"\0")):
                fed = True
                yield unpack.decompress(data, CHUNK)
                data = unpack.unconsumed_tail
                if unpack.eof:
                    data, unpack, fed = unpack.unused_data, zlib.decompressobj(31), False
        while fed and (chunk := unpack.decompress(b"", CHUNK)):  # what a full chunk left inside
            yield chunk
            fed = not unpack.eof
    except zlib.error as e:
        raise ValueError(f"{where} is no gzip file: {e}") from e
    if fed:
        raise ValueError(f"{where} ends inside a gzip member")


def records(chunks: Iterator[bytes], where: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, whole record) of a stream of WARC records."""
    buf = bytearray()

    def fill(n: int) -> bool:
        while len(buf) < n:
            chunk = next(chunks, None)
            if chunk is None:
                return False
            buf.extend(chunk)
        return True

    while True:
        while (end := buf.find(b"\r\n\r\n")) < 0 and fill(len(buf) + 1):
            pass
        if end < 0:
            if buf.strip():
                raise ValueError(f"{where} ends inside a WARC header")
            return
        version, *lines = buf[:end].decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"{where}: no WARC record where one should begin")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = end + 4 + int(headers["content-length"]) + 4
        if not fill(size):
            raise ValueError(f"{where} ends inside a WARC record")
        yield headers, bytes(buf[:size])
        del buf[:size]


def _normalise(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_fs, base = open_store(folder)
        out_fs.create_dir(base, recursive=True)
        for batch in batches:
            rows = []
            for archive in batch.column("archive").to_pylist():
                fs, path = open_store(archive)
                name, offset, n = uuid.uuid4().hex, 0, 0
                with fs.open_input_stream(path, compression=None) as src, out_fs.open_output_stream(f"{base}/{name}.warc.gz", compression=None) as out, out_fs.open_output_stream(f"{base}/{name}.idx.jsonl", compression=None) as index:
                    for headers, record in records(inflated(src, archive), archive):
                        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                        member = packer.compress(record) + packer.flush()
                        out.write(member)
                        index.write(json.dumps({"offset": offset, "length": len(member), "type": headers.get("warc-type"), "id": headers.get("warc-record-id")}).encode() + b"\n")
                        offset, n = offset + len(member), n + 1
                rows.append((f"{folder}/{name}.warc.gz", f"{folder}/{name}.idx.jsonl", n))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], ["archive", "index", "n_records"])

    return run, "archive string, index string, n_records long"


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """(archive, index, n_records) of archives rewritten with a gzip member per record.

    The input may hold whole-stream files, files with members already, or a mix. A file that
    ends inside a member or record raises an error that names it.
    """
    run, schema = _normalise(folder)
    spread = archives.repartition(max(1, min(archives.count(), 10_000)))  # a task has few archives, an archive is never split
    return written(spread.mapInArrow(run, schema))


def _page(headers: dict[str, str], key: str) -> int | None:
    value = headers.get(key, "").removeprefix("<urn:page:").partition(":")[0]
    return int(value) if value else None


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

    for batch in batches:
        for archive, index in zip(batch.column("archive").to_pylist(), batch.column("index").to_pylist(), strict=True):
            (fs, path), (index_fs, index_path) = open_store(archive), open_store(index)
            rows, size = [], 0
            with fs.open_input_file(path) as file, index_fs.open_input_file(index_path) as lines:
                for line in lines.read().splitlines():
                    entry = json.loads(line)
                    file.seek(entry["offset"])
                    (headers, record), = records(iter([zlib.decompress(file.read(entry["length"]), 31)]), archive)
                    block = record[record.index(b"\r\n\r\n") + 4 : -4]
                    http, _, payload = block.partition(b"\r\n\r\n")
                    kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
                    n = int(re.search(rb"(?i)content-length: *(\d+)", http)[1])
                    if kind == "response" and (n != len(payload) or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                        raise ValueError(f"{archive} at {entry['offset']}: the payload is not what its header says")
                    rows.append((_page(headers, "warc-record-id"), headers["warc-target-uri"], n, digest, kind, _page(headers, "warc-refers-to"), payload if kind == "response" else None))
                    size += len(payload)
                    if size > 4 * CHUNK:
                        yield batch_of(rows)
                        rows, size = [], 0
            if rows:
                yield batch_of(rows)


def read_archives(normalised: DataFrame) -> DataFrame:
    """One row per record: page_id, url, payload_bytes, payload_digest, record_type, refers_to
    and payload (null for revisits), each read at the offset in the sidecar index; the digest
    of a response is recomputed and must be that of its header."""
    spread = normalised.repartition(max(1, min(normalised.count(), 10_000)))
    return spread.mapInArrow(_read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Pages written to archives, normalised and read back, in folders that all machines share.

    Null html is an empty payload, a null url about:blank, control characters in a url are
    percent-encoded. A null id is always a response. Rows that repeat an id get a record each;
    if the payloads are equal and the id is the smallest, both are responses, under record ids
    that end in a number. Other columns are not looked at. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    archives = write_archives(pages, shared_folder(spark), id_col, url_col, html_col, min_bytes)
    return read_archives(normalise(archives, shared_folder(spark)))


#: What ``round_trip`` returns on the table pages (min_bytes 0, no payload), in DuckDB's SQL; 20 bits are four digits of base32.
ROUND_TRIP_SQL = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, coalesce(url, 'about:blank') AS url, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((CAST('0x' || substr(p.h, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN f ON f.h = p.h
"""
