"""Archives that inflate far beyond their size, and record ids."""

import gzip
import io
import tracemalloc

import pytest
from pyspark.sql import functions as F

from millrace.llm import warc
from millrace.workspace import shared_folder


def test_inflated_chunks_are_bounded():
    whole = b"".join(warc.record_bytes(i, "u", bytes(900_000), "D", None) for i in range(40)) + b"".join(warc.record_bytes(i, "u", b"x" * i, "D", None) for i in range(300))
    for packed in (gzip.compress(whole), b"".join(gzip.compress(whole[i : i + 3_000_001]) for i in range(0, len(whole), 3_000_001))):
        chunks = list(warc.inflated(io.BytesIO(packed), "here"))
        assert b"".join(chunks) == whole and max(map(len, chunks)) <= warc.CHUNK
    assert len(list(warc.records(warc.inflated(io.BytesIO(gzip.compress(whole)), "here"), "here"))) == 340


def test_a_gigabyte_of_records_is_read_in_little_memory():
    """About 1.05 GB of records in a file of about 1 MB."""
    record = warc.record_bytes(1, "u", bytes(1 << 20), "D", None)
    out = io.BytesIO()
    with gzip.GzipFile(fileobj=out, mode="wb", compresslevel=6) as f:
        for _ in range(1000):
            f.write(record)
    out.seek(0)
    tracemalloc.start()
    n = sum(1 for _ in warc.records(warc.inflated(out, "here"), "here"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 1000 and peak < 64 << 20


def test_record_ids_are_unique(spark):
    rows = [(1, "a", "same"), (1, "b", "same"), (1, "c", "other"), (2, "d", "same"), (2, "d", "same"), (None, "e", "same"), (None, "e", "same")]
    archives = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), shared_folder(spark))
    normal = warc.normalise(archives, shared_folder(spark))
    ids, targets = [], []
    for r in normal.collect():
        with gzip.open(r.archive.removeprefix("file://")) as f:
            for headers, _ in warc.records(iter([f.read()]), r.archive):
                ids.append(headers["warc-record-id"])
                targets += [headers["warc-refers-to"]] if "warc-refers-to" in headers else []
    assert len(ids) == len(set(ids)) == 7 and len(targets) == 2 and set(targets) <= set(ids)
    assert warc.read_archives(normal).where(F.col("record_type") == "revisit").count() == 2


def test_padding_after_members():
    """Zeros between and after members, also over the bounds of what is read at once."""
    one, two = gzip.compress(b"first " * 1000), gzip.compress(b"second")
    for pad in (1, 511, 3 << 20):
        assert b"".join(warc.inflated(io.BytesIO(one + bytes(pad) + two + bytes(pad)), "f")) == b"first " * 1000 + b"second"
    with pytest.raises(ValueError, match="a.gz is no gzip file"):
        list(warc.inflated(io.BytesIO(one + b"\0\0rubbish that is no member"), "a.gz"))
