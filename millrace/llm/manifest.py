"""A Merkle manifest of a table: digests of rows, folded by source, and proofs by descent.

Every row is a leaf. The leaves of a source, in the order of their ids, are folded: each run of
``ARITY`` neighbouring nodes becomes the digest of their digests, until one is left, the
subroot. The subroots in the order of their sources are folded likewise, to the root.

What is stored is content-addressed: records from a digest to its children's digests. The
records of ``LEVELS`` levels below a node lie in one row, a page, so a tree of n leaves takes
log(n) / log(ARITY ** LEVELS) rounds to build and to descend, each a shuffle of pages.

A proof starts at the root. A leaf's rank, written in base ARITY, names the child to take at each
level; the children that are not taken are collected. Requests descend together: what goes down is
one row for every page that a request reaches, not one per request, so the root is read once.
The path comes out root first, level by level, and is reversed for the proof.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

ARITY = 3
#: Levels of a page, and the nodes below it.
LEVELS = 6
PAGE = ARITY**LEVELS

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def row_digest(values: Sequence[Column]) -> Column:
    """SHA-256 of the values' texts: "-" for null, else the number of UTF-8 bytes, a colon and the text."""
    parts = []
    for v in values:
        text = v.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def fold(digests: Sequence[bytes]) -> bytes:
    """The digest of a run of nodes: SHA-256 of their hexadecimal digests."""
    return hashlib.sha256("".join([d.hex() for d in digests]).encode()).digest()


def build_page(nodes: list[bytes], levels: int) -> tuple[bytes, dict[bytes, list[bytes]]]:
    """(top, records of digest to children) of the nodes below a page, folded ``levels`` times.
    Equal subtrees have one record."""
    records: dict[bytes, list[bytes]] = {}
    for _ in range(levels):
        runs = [nodes[i : i + ARITY] for i in range(0, len(nodes), ARITY)]
        nodes = [fold(run) for run in runs]
        records.update(zip(nodes, runs, strict=True))
    return nodes[0], records


def descend_page(top: bytes, records: dict[bytes, list[bytes]], place: int, levels: int) -> tuple[bytes, list[tuple[int, list[bytes]]]]:
    """The node at ``place`` below a page and the path to it, from the top: (child taken, other children)."""
    path = []
    for level in reversed(range(levels)):
        digit = place // ARITY**level % ARITY
        children = records[top]
        path.append((digit, children[:digit] + children[digit + 1 :]))
        top = children[digit]
    return top, path


def climb(leaf: bytes, path: Sequence[tuple[int, list[bytes]]]) -> bytes:
    """The root that a leaf and the other children on its path, given root first, fold to."""
    for taken, others in reversed(path):
        leaf = fold([*others[:taken], leaf, *others[taken:]])
    return leaf


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one, so that one page at a time is in memory as objects."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch.column(c)[i].as_py() for c in batch.schema.names}


_RECORDS = pa.list_(pa.struct([("digest", pa.binary()), ("children", pa.list_(pa.binary()))]))
_PATH = pa.list_(pa.struct([("taken", pa.int32()), ("others", pa.list_(pa.binary()))]))
_PATH_SQL = "array<struct<taken:int,others:array<binary>>>"
_PAGES_SQL = "tree string, rank long, size long, whole long, digest binary, levels int, records array<struct<digest:binary,children:array<binary>>>"


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _each(batches):
        top, records = build_page([x["digest"] for x in sorted(row["nodes"], key=lambda x: x["rank"])], row["levels"])
        cells = [(row["tree"], pa.string()), (row["page"], pa.int64()), (row["size"], pa.int64()), (row["whole"], pa.int64()), (top, pa.binary()), (row["levels"], pa.int32()), ([{"digest": d, "children": c} for d, c in records.items()], _RECORDS)]
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in cells], ["tree", "rank", "size", "whole", "digest", "levels", "records"])


def ranked(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with rank, their place from 0 among those of their tree in the given order, and size, how
    many there are. The tree is never null, and the columns of the order tell all rows apart; nulls come first.

    A sort by ranges deals out trees of any size. A row's rank is its place in its partition and
    what earlier partitions have of its tree, one number per partition and tree.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in (tree, *order)]
    # the partition is in the upper bits of the place
    placed = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    placed = written(placed.withColumn("part", F.shiftrightunsigned("at", 33)))
    counts = placed.groupBy(tree, "part").agg(F.count(F.lit(1)).alias("here"), F.min("at").alias("first"))
    own = Window.partitionBy(tree)  # a row per partition
    before = F.coalesce(F.sum("here").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(tree, "part", (F.col("first") - before).alias("zero"), F.sum("here").over(own).alias("size"))
    return placed.join(starts, [tree, "part"]).select(*rows.columns, (F.col("at") - F.col("zero")).alias("rank"), "size")


def _above(c: str, powers: Sequence[int]) -> Column:
    """How many of the powers ``c`` exceeds."""
    return sum((F.when(F.col(c) > p, 1).otherwise(0) for p in powers), F.lit(0)).cast("int")


def _height(c: str) -> Column:
    """Rounds of a tree of so many leaves."""
    return _above(c, [PAGE**i for i in range(7)])


def build(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(pages of each round, lowest first; (tree, size, digest) of the roots) over (tree, rank, size, digest).

    A page that is not the last of its tree is folded to its full height, and so is a shorter one beside others.
    """
    rounds, roots = [], nodes.where("size = 1").select("tree", "size", "digest")
    nodes = nodes.where("size > 1").withColumn("whole", F.col("size"))
    while not nodes.isEmpty():
        runs = nodes.groupBy("tree", F.floor(F.col("rank") / PAGE).alias("page"), "size", "whole").agg(F.collect_list(F.struct("rank", "digest")).alias("nodes"))
        pages = written(runs.withColumn("levels", _above("size", [ARITY**i for i in range(LEVELS)])).mapInArrow(_pages, _PAGES_SQL))
        rounds.append(pages)
        nodes = pages.select("tree", "rank", F.ceil(F.col("size") / PAGE).alias("size"), "whole", "digest")
        roots = roots.union(nodes.where("size = 1").select("tree", "whole", "digest"))
        nodes = nodes.where("size > 1")
    return rounds, roots


def _step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes that requests reach below a page, each with the path to it."""
    for row in _each(batches):
        records = {r["digest"]: r["children"] for r in row["records"] or ()}
        found = [descend_page(row["digest"], records, place, row["levels"] or 0) for place in row["places"]]
        paths = [row["path"] + [{"taken": i, "others": o} for i, o in more] for _, more in found]
        n = len(found)
        cells = [([row["tree"]] * n, pa.string()), ([row["page"] * PAGE + p for p in row["places"]], pa.int64()), ([row["start"]] * n, pa.binary()), ([node for node, _ in found], pa.binary()), (paths, _PATH)]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in cells], ["tree", "rank", "start", "digest", "path"])


_REACHED_SQL = f"tree string, rank long, start binary, digest binary, path {_PATH_SQL}"


def _lowest(rounds: list[DataFrame], starts: DataFrame, requests: DataFrame) -> DataFrame:
    """(tree, page, start, digest, path, levels, records): the pages of the lowest round that requests
    (tree, rank, size) reach from the starts (tree, size, digest, path), where their trees begin.

    Each round joins the pages reached with its records by digest and follows the next digits
    of the ranks. A tree of one leaf has no records.
    """
    front = None
    for i in reversed(range(max(1, len(rounds)))):
        here = starts.where(F.greatest(_height("size"), F.lit(1)) == i + 1).select("tree", F.lit(0).cast("long").alias("page"), F.col("digest").alias("start"), "digest", "path")
        if front is not None:
            here = here.union(front.select("tree", F.col("rank").alias("page"), "start", "digest", "path"))
        if i < len(rounds):  # equal pages are one
            here = here.join(rounds[i].select("digest", "levels", "records").dropDuplicates(["digest"]), "digest", "left")
        else:
            here = here.withColumns({"levels": F.lit(0), "records": F.lit(None).cast("array<struct<digest:binary,children:array<binary>>>")})
        if i == 0:
            return here
        nodes = requests.where(_height("size") > i).select("tree", F.floor(F.col("rank") / PAGE**i).alias("node")).distinct()
        places = nodes.groupBy("tree", F.floor(F.col("node") / PAGE).alias("page")).agg(F.collect_list(F.col("node") % PAGE).alias("places"))
        front = here.join(places, ["tree", "page"]).mapInArrow(_step, _REACHED_SQL)
    raise AssertionError


def paths(rounds: list[DataFrame], starts: DataFrame, requests: DataFrame) -> DataFrame:
    """(tree, rank, start, digest, path) of the leaves that requests (tree, rank, size) name."""
    places = requests.groupBy("tree", F.floor(F.col("rank") / PAGE).alias("page")).agg(F.collect_list(F.col("rank") % PAGE).alias("places"))
    return _lowest(rounds, starts, requests).join(places, ["tree", "page"]).mapInArrow(_step, _REACHED_SQL)


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last step of the descent, which ends in a proof and in what the leaf shown folds to."""
    for row in _each(batches):
        records = {r["digest"]: r["children"] for r in row["records"] or ()}
        above = [(s["taken"], s["others"]) for s in row["path"]]
        out = []
        for ask in row["asks"]:
            leaf, more = descend_page(row["digest"], records, ask["place"], row["levels"] or 0)
            path = above + more
            proof = [d for _, others in reversed(path) for d in others]
            out.append((ask["doc_id"], leaf.hex(), row["start"].hex(), fold(proof).hex(), climb(ask["shown"], path).hex()))
        kinds = (pa.int64(), *[pa.string()] * 4)
        yield pa.RecordBatch.from_arrays([pa.array(list(v), k) for v, k in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "leaf", "subroot", "proof_sha256", "folded_root"])


@dataclass
class Manifest:
    #: tree, doc_id, rank, size, digest; a row per leaf. ``tree`` is "=" and the source, or "" where that is null.
    leaves: DataFrame
    #: The pages of the trees of sources, a table per round, lowest first.
    pages: list[DataFrame]
    #: tree (""), source_tree, rank, size, leaves, digest; a row per source.
    subroots: DataFrame
    #: The pages of the tree of subroots.
    top_pages: list[DataFrame]
    #: None: the table is empty.
    root: bytes | None


def manifest(docs: DataFrame, columns: Sequence[str] = COLUMNS, id_col: str = "doc_id", source_col: str = "source", **kept: Column) -> Manifest:
    """The records, subroots and root of a table. Leaves digest ``columns`` in their order.

    Leaves of a source ascend by id, nulls first, rows that repeat an id by their digests. A null
    source is a source of its own, before all others. ``kept`` are further columns of the leaves, over
    ``docs``. Columns that are not named are not looked at. An empty table has no root.
    """
    value = F.col(f"`{source_col}`").cast("string")
    leaves = docs.select(F.coalesce(F.concat(F.lit("="), value), F.lit("")).alias("tree"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), row_digest([F.col(f"`{c}`") for c in columns]).alias("digest"), *(c.alias(n) for n, c in kept.items()))
    # a number tells equal rows apart, in a table so that it stays as it is
    leaves = written(leaves.withColumn("copy", F.monotonically_increasing_id()))
    leaves = written(ranked(leaves, "tree", ["doc_id", "digest", "copy"]).drop("copy"))
    pages, roots = build(leaves.select("tree", "rank", "size", "digest"))
    subroots = roots.select(F.lit("").alias("tree"), F.col("tree").alias("source_tree"), F.col("size").alias("leaves"), "digest")
    subroots = written(ranked(written(subroots), "tree", ["source_tree"]))
    top_pages, roots = build(subroots.select("tree", "rank", "size", "digest"))
    found = roots.first()  # the only one
    return Manifest(leaves, pages, subroots, top_pages, bytes(found["digest"]) if found else None)


def prove(m: Manifest, requests: DataFrame, shown: str = "digest") -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for ``requests``, rows of ``m.leaves``.

    The proof of a leaf is the other children of its run, level by level from below, through its
    subroot to the root, left to right; proof_sha256 folds their digests. ``shown`` names the column
    with the digest that the holder of the row shows: folded_root is what it folds to with the
    proof, and verified says whether that is the root.
    """
    # one row, in a table, as a join on a literal would be none on a key
    top = written(m.subroots.where("rank = 0").select("tree", "size", F.lit(m.root).cast("binary").alias("digest"), F.array().cast(_PATH_SQL).alias("path")))
    at = paths(m.top_pages, top, m.subroots).select("rank", "path")
    starts = m.subroots.join(at, "rank").select(F.col("source_tree").alias("tree"), F.col("leaves").alias("size"), "digest", "path")
    asks = requests.groupBy("tree", F.floor(F.col("rank") / PAGE).alias("page")).agg(F.collect_list(F.struct((F.col("rank") % PAGE).alias("place"), "doc_id", F.col(shown).alias("shown"))).alias("asks"))
    lowest = _lowest(m.pages, written(starts), requests.select("tree", "rank", "size"))
    out = lowest.join(asks, ["tree", "page"]).mapInArrow(_prove, "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string")
    root = F.lit((m.root or b"").hex())
    return out.select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))


def audit(docs: DataFrame) -> DataFrame:
    """Every row of a documents table proved against the manifest of all of them.

    Rows whose id has an even CRC-32 (as decimal text) are shown with the line feeds of their text
    deleted, and are verified only if there are none; a null id or text stays as it is.
    """
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    text = F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    m = manifest(docs, shown=row_digest([text if c == "text" else F.col(c) for c in COLUMNS]))
    return prove(m, m.leaves, "shown")


#: What ``audit`` returns, for DuckDB, which has no CRC-32: it is worked out bit by bit.
MANIFEST_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, lang, n_chars, text, CASE WHEN bits.crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS shown FROM documents LEFT JOIN (
    SELECT id, xor(list_reduce(list_transform(range(length(id)), lambda i: CAST(ascii(id[i + 1]) AS BIGINT)), lambda crc, byte: list_reduce(range(8), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, byte)), 4294967295), 4294967295) AS crc
    FROM (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS id FROM documents WHERE doc_id IS NOT NULL)) AS bits ON bits.id = CAST(doc_id AS VARCHAR)),
cells AS (SELECT doc_id, source, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head, text, shown FROM docs),
leaves AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY source) AS n, leaf, changed FROM (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || coalesce(strlen(shown) || ':' || shown, '-')) AS changed FROM cells)),
nodes AS (SELECT source, 0 AS level, rank, n, leaf AS h FROM leaves
  UNION ALL SELECT source, level + 1, rank // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY rank)) FROM nodes WHERE n > 1 GROUP BY source, level, rank // 3, n),
subroots AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS rank, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (SELECT 0 AS level, rank, n, subroot AS h FROM subroots
  UNION ALL SELECT level + 1, rank // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY rank)) FROM tops WHERE n > 1 GROUP BY level, rank // 3, n),
steps AS (SELECT l.doc_id, l.source, l.rank AS leaf_rank, o.level, o.rank, o.h, CAST(pow(3, o.level) AS BIGINT) AS width FROM leaves l JOIN nodes o ON o.source IS NOT DISTINCT FROM l.source AND o.n > 1 AND o.rank // 3 = l.rank // CAST(pow(3, o.level + 1) AS BIGINT)
  UNION ALL SELECT l.doc_id, l.source, l.rank, 100 + o.level, o.rank, o.h, CAST(pow(3, o.level) AS BIGINT) FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source JOIN tops o ON o.n > 1 AND o.rank // 3 = s.rank // CAST(pow(3, o.level + 1) AS BIGINT)),
taken AS (SELECT t.*, t.rank = CASE WHEN t.level < 100 THEN t.leaf_rank ELSE s.rank END // t.width AS own FROM steps t JOIN subroots s ON s.source IS NOT DISTINCT FROM t.source),
runs AS (SELECT source, leaf_rank, row_number() OVER (PARTITION BY source, leaf_rank ORDER BY level) AS step, string_agg(h, '' ORDER BY rank) FILTER (NOT own) AS others,
  coalesce(string_agg(h, '' ORDER BY rank) FILTER (NOT own AND rank < own_rank), '') AS before, coalesce(string_agg(h, '' ORDER BY rank) FILTER (NOT own AND rank > own_rank), '') AS after
  FROM (SELECT *, max(rank) FILTER (own) OVER (PARTITION BY source, leaf_rank, level) AS own_rank FROM taken) GROUP BY source, leaf_rank, level),
proofs AS (SELECT source, leaf_rank, sha256(coalesce(string_agg(others, '' ORDER BY step), '')) AS proof FROM runs GROUP BY source, leaf_rank),
climbs AS (SELECT source, rank AS leaf_rank, 0 AS step, changed AS h FROM leaves
  UNION ALL SELECT c.source, c.leaf_rank, c.step + 1, sha256(r.before || c.h || r.after) FROM climbs c JOIN runs r ON r.source IS NOT DISTINCT FROM c.source AND r.leaf_rank = c.leaf_rank AND r.step = c.step + 1),
folded AS (SELECT source, leaf_rank, arg_max(h, step) AS h FROM climbs GROUP BY source, leaf_rank)
SELECT l.doc_id, l.leaf, s.subroot, t.h AS root, coalesce(p.proof, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source JOIN tops t ON t.n = 1 JOIN folded f ON f.source IS NOT DISTINCT FROM l.source AND f.leaf_rank = l.rank
LEFT JOIN proofs p ON p.source IS NOT DISTINCT FROM l.source AND p.leaf_rank = l.rank
"""
