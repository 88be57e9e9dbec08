"""The manifest against a direct fold of all rows, for trees of every small size and of several pages."""

import hashlib
import zlib

import pytest
from helpers import awkward, empty
from pyspark.sql import functions as F

from millrace.llm.manifest import COLUMNS, audit, build_page, climb, descend_page, manifest, prove

H = lambda s: hashlib.sha256(s.encode()).hexdigest()


def leaf(row, text):
    cells = [row[c] if c != "text" else text for c in COLUMNS]
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in cells))


def proofs(nodes):
    """(root, path of (siblings before, siblings after) for each node)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for n, i in enumerate(at):
            run = i - i % 3
            paths[n].append((nodes[run:i], nodes[i + 1 : run + 3]))
        nodes = [H("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
        at = [i // 3 for i in at]
    return nodes[0], paths


def brute(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for t in trees.values():
        t.sort(key=lambda x: x[:3])
    inner = [proofs([x[2] for x in trees[s]]) for s in names]
    root, tops = proofs([sub for sub, _ in inner])
    out = []
    for s, (sub, paths), top in zip(names, inner, tops, strict=True):
        for (_, _, digest, r), path in zip(trees[s], paths, strict=True):
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and r["text"] is not None
            node = leaf(r, r["text"].replace("\n", "")) if tampered else digest
            for before, after in path + top:
                node = H("".join(before) + node + "".join(after))
            out.append((r["doc_id"], digest, sub, root, H("".join(d for before, after in path + top for d in before + after)), node, node == root))
    return out


def same(df):
    rows = [r.asDict() for r in df.collect()]
    got = [tuple(r) for r in audit(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows)))


def test_trees_of_every_small_size(spark):
    """Sources of 1 to 30 rows, and one of 800, which takes two rounds of pages."""
    rows = [(n * 1000 + i, f"s{n}", None if i % 5 else "en", i, f"row {i}\nof {n}") for n in range(1, 31) for i in range(n)]
    rows += [(i, "é" if i % 2 else None, "de", None, f"a\nb {i}" if i % 7 else None) for i in range(100_000, 101_600)]
    same(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"))


def test_one_source_and_one_row(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    same(spark.createDataFrame([(7, "a", "en", 3, "a\nb")], schema))
    same(spark.createDataFrame([(i, "a", "en", 3, "a\nb") for i in range(5)], schema))


def test_awkward_rows(spark):
    """Null and repeated ids, equal rows, null texts, other columns under clashing names."""
    same(awkward(spark, "doc_id long, text string, source string").withColumns({"lang": F.lit("en"), "n_chars": F.length("text").cast("long"), "digest": F.lit("x"), "rank": F.lit("x"), "tree": F.lit("x")}))
    same(spark.createDataFrame([(1, "a", "en", 3, "equal\nrows")] * 900 + [(2, "a", "en", 3, "another")], "doc_id long, source string, lang string, n_chars long, text string"))


def test_empty_table(spark):
    assert audit(empty(spark)).count() == 0
    assert manifest(empty(spark)).root is None


def test_some_requests(spark):
    """Few rows of a large tree are proved like all of them; a changed row is not."""
    df = spark.range(2000).selectExpr("id AS doc_id", "concat('s', id % 3) AS source", "'en' AS lang", "id AS n_chars", "concat('text ', id) AS text")
    m = manifest(df)
    some = m.leaves.where("doc_id IN (5, 500, 1999)")
    got = {r.doc_id: r for r in prove(m, some).collect()}
    assert set(got) == {5, 500, 1999} and all(r.verified for r in got.values())
    bad = prove(m, some.withColumn("digest", F.unhex(F.sha2(F.lit("x"), 256)))).collect()
    assert len(bad) == 3 and not any(r.verified for r in bad)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 81, 200, 729])
def test_pages(n):
    nodes = [hashlib.sha256(str(i % 50).encode()).digest() for i in range(n)]
    levels = 0
    while 3**levels < n:
        levels += 1
    top, records = build_page(nodes, levels)
    for i, node in enumerate(nodes):
        found, path = descend_page(top, records, i, levels)
        assert found == node and climb(node, path) == top
