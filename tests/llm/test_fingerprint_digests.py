"""The recovered digests are exactly those of the paragraphs that differ; fingerprint strings."""

import re

import pytest
from helpers import SF, documents
from pyspark.sql import functions as F

from millrace.llm import fingerprints
from millrace.llm.fingerprints import CELLS, PIECE, fingerprint_versions, paragraphs
from millrace.llm.queries import op2_invertible_fingerprints


def digests(spark, texts):
    """text -> its digests by piece, hashed one by one."""
    found = {p for t in texts for p in re.findall(PIECE, t)}
    hashed = spark.createDataFrame([(p,) for p in found], "p string").select("p", F.xxhash64("p").alias("h"))
    by = {r.p: r.h for r in hashed.collect()}
    return lambda t: {by[p] for p in re.findall(PIECE, t)}


def versions(rows):
    rows = sorted(rows, reverse=True)
    for i, (d, t) in enumerate(rows):
        k = len(t) // 3
        yield d, t, t[: len(t) - k] + rows[(i + 1) % len(rows)][1][:k]


@pytest.mark.parametrize("rows", ["tables", "made"])
def test_recovered_digests(spark, rows):
    if rows == "tables":
        rows, got = [(r.doc_id, r.text) for r in documents(spark).collect()], op2_invertible_fingerprints(spark, SF)
    else:  # from no paragraph to thousands, near copies among them
        sizes = [0, 1, 2, 7, 24, 25, 60, 400, 3000]
        rows = [(10 * i + j, "\n".join(f"{'ab'[j]}{n if n % 9 else i}" for n in range(size))) for i, size in enumerate(sizes) for j in range(2)]
        got = fingerprint_versions(spark.createDataFrame(rows, "doc_id long, text string"))
    of = digests(spark, [x for d, t, e in versions(rows) for x in (t, e)])
    got = {r.doc_id: r for r in got.collect()}
    for d, t, e in versions(rows):
        assert got[d].only_text == sorted(of(t) - of(e)) and got[d].only_edited == sorted(of(e) - of(t)), d


def test_fingerprint_is_the_sketch_of_the_set(spark):
    """Cell by cell: count, XOR of digests, XOR of check hashes."""
    texts = ["", "one", "a b\nc d\na b", "\n".join(f"line {i}" for i in range(100))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {}
    for r in df.select("doc_id", F.transform(paragraphs(F.col("text")), lambda k: F.struct(k.alias("k"), F.hash(k).alias("h"))).alias("a")).collect():
        cells = [[0, 0, 0] for _ in range(CELLS)]
        for k, h in r.a:
            for table in range(3):
                c = cells[8 * table + (k >> 3 * table & 7)]
                c[0], c[1], c[2] = c[0] + 1, c[1] ^ (k & (1 << 64) - 1), c[2] ^ (h & 0xFFFFFFFF)
        want[r.doc_id] = f"{len(r.a)}:" + "".join(f"{n & 255:02X}{k:016X}{h:08X}" for n, k, h in cells)
    assert {r.doc_id: r.fingerprint for r in fingerprint_versions(df).collect()} == want


def test_blocks_that_fail_three_times(spark, monkeypatch):
    """With blocks far too small for what differs, the digests come from the table of failed blocks."""
    levels, whole = [], fingerprints.differences

    def counted(failed, level=3):
        levels.append(failed.count())
        return whole(failed, level)

    monkeypatch.setattr(fingerprints, "BLOCK_KEYS", 400)
    monkeypatch.setattr(fingerprints, "differences", counted)
    rows = [(1, "\n".join(f"left {n}" for n in range(300))), (2, "\n".join(f"right {n}" for n in range(300))), (3, "")]
    got = {r.doc_id: r for r in fingerprint_versions(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    of = digests(spark, [x for d, t, e in versions(rows) for x in (t, e)])
    for d, t, e in versions(rows):
        assert got[d].only_text == sorted(of(t) - of(e)) and got[d].only_edited == sorted(of(e) - of(t)), d
    assert levels[0] > 0 and got[2].near_next == 0
