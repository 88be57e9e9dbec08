"""Document fingerprints as invertible Bloom lookup sketches.

A text is the set of its paragraphs (lines, long ones cut into runs of words), each hashed
to a 64-bit digest. The sketch has CELLS cells in three tables; a digest is added to one cell
of each: cell = (count, XOR of digests, XOR of their check hashes). Two sketches subtract
cell by cell, common paragraphs vanish, and peeling takes out the differing digests: a cell
that holds one digest names it, and taking it out of its other cells uncovers more.

The sketch of a whole text is its fingerprint. If cells are left when two of them are
subtracted, it was too small for the difference. Then each version is sketched again, larger, in
as many blocks of cells as the sizes of the sets call for; the two sketches are subtracted and
peeled block by block. Blocks that still fail are split in four, with other cell positions,
until all are peeled. So the recovered digests are always exactly those that differ.

All of this is array expressions in the row of the pair; what moves between tasks is one
copy of the texts (to stand beside their neighbours). Only blocks that fail three times
go on to a table of their own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import two_columns, written

#: Three tables of eight cells: positions are bits 0-2, 3-5 and 6-8 of the digest.
CELLS = 24
#: Words of a line that make a paragraph at most.
PIECE_WORDS = 16
PIECE = r"[^\x20\x09-\x0D]+(?:[\x20\x09]+[^\x20\x09-\x0D]+){0,%d}" % (PIECE_WORDS - 1)
#: Cells in each of a retried block's three tables; the digests that should differ in one, on average; rounds of peeling.
BLOCK_WIDTH, BLOCK_KEYS, ROUNDS = 4, 3, 6
#: How many digests of two sets have one that differs among them: about a third of those of a text
#: and its edited version, all of those of two documents.
VERSIONS, DOCUMENTS = 3, 1
#: Rows in a range of ids.
RANGE_ROWS = 2_000


def paragraphs(text: Column) -> Column:
    """Sorted distinct digests."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), lambda p: F.xxhash64(p))))


def _at(key: str, level: int) -> str:
    """The bits that place a digest; those of a fresh hash when its own ones have failed twice."""
    return key if level <= 1 else f"xxhash64({key}, {level})"


def _empty(width: int) -> str:
    """SQL for the empty cells of three tables; b and v tell which digests belong in one: those whose bits from b on are v."""
    bits = width.bit_length() - 1
    return f"transform(sequence(0, {3 * width - 1}), c -> named_struct('n', 0, 'k', 0L, 'h', 0, 'b', {bits} * (c div {width}), 'v', cast(c % {width} AS bigint)))"


def _changed(cell: str, key: str, by: str) -> str:
    return f"named_struct('n', {cell}.n {by}, 'k', {cell}.k ^ {key}, 'h', {cell}.h ^ hash({key}), 'b', {cell}.b, 'v', {cell}.v)"


def _belongs(key: str, cell: str, level: int, width: int) -> str:
    return f"(shiftrightunsigned({_at(key, level)}, {cell}.b) & {width - 1}L) = {cell}.v"


def sketch(keys: str, level: int = 0, width: int = CELLS // 3) -> str:
    """SQL for the cells of an array of digests."""
    return f"transform({_empty(width)}, z -> aggregate({keys}, z, (s, x) -> if({_belongs('x', 's', level, width)}, {_changed('s', 'x', '+ 1')}, s)))"


def subtract(a: str, b: str) -> str:
    return f"zip_with({a}, {b}, (s, t) -> named_struct('n', s.n - t.n, 'k', s.k ^ t.k, 'h', s.h ^ t.h, 'b', s.b, 'v', s.v))"


def peel(cells: str, level: int = 0, width: int = CELLS // 3) -> str:
    """SQL for struct(ok, more, less): whether all cells emptied, and the digests that only the first and only the second set has."""
    pure = "array_distinct(transform(filter(st.cells, s -> abs(s.n) = 1 AND hash(s.k) = s.h), s -> named_struct('k', s.k, 'n', s.n)))"
    after = f"transform(st.cells, s -> aggregate(p, s, (t, q) -> if({_belongs('q.k', 't', level, width)}, {_changed('t', 'q.k', '- q.n')}, t)))"
    of = lambda sign: f"transform(filter(p, q -> q.n = {sign}), q -> q.k)"
    step = f"""transform(array({pure}), p -> if(size(p) = 0, named_struct('cells', st.cells, 'more', st.more, 'less', st.less, 'go', false),
        named_struct('cells', {after}, 'more', concat(st.more, {of(1)}), 'less', concat(st.less, {of(-1)}), 'go', true)))[0]"""
    none = "cast(array() AS array<bigint>)"
    return f"""aggregate(sequence(1, {ROUNDS}), named_struct('cells', {cells}, 'more', {none}, 'less', {none}, 'go', true), (st, r) -> if(st.go, {step}, st),
        st -> named_struct('ok', forall(st.cells, s -> s.n = 0 AND s.k = 0 AND s.h = 0), 'more', st.more, 'less', st.less))"""


def packed_cells(cells: str) -> Column:
    """Count, digests and checks of each cell, 13 bytes a cell."""
    return F.expr(f"unhex(array_join(transform({cells}, s -> concat(lpad(hex(s.n & 255), 2, '0'), lpad(hex(s.k), 16, '0'), lpad(right(hex(s.h), 8), 8, '0'))), ''))")


def written_form(size: str, cells: str) -> Column:
    """A sketch as text: the set's size and the packed cells in hexadecimal."""
    return F.concat(F.col(size).cast("string"), F.lit(":"), F.hex(cells))


def _split(keys: str, rows: str, columns: str, level: int) -> str:
    """SQL for an array of rows * columns arrays: digests by two remainders, in two steps so that the work is about keys * (rows + columns)."""
    part = lambda bits, of, value: f"pmod(shiftright({_at('x', level)}, {bits}), {of}) = {value}"
    return f"""flatten(transform(sequence(0, {rows} - 1), g -> transform(array(filter({keys}, x -> {part(9, rows, "g")})),
        some -> transform(sequence(0, {columns} - 1), j -> filter(some, x -> {part(25, columns, "j")})))[0]))"""


def tried(a: str, b: str, rows: str, columns: str, level: int) -> str:
    """SQL for an array of struct(a, b, p): two digest arrays cut into rows * columns blocks, and for
    each block what peeling the subtracted sketches of its two parts gives."""
    difference = subtract(sketch("block.a", level, BLOCK_WIDTH), sketch("block.b", level, BLOCK_WIDTH))
    blocks = f"zip_with({_split(a, rows, columns, level)}, {_split(b, rows, columns, level)}, (l, m) -> named_struct('a', l, 'b', m))"
    return f"transform({blocks}, block -> named_struct('a', block.a, 'b', block.b, 'p', {peel(difference, level, BLOCK_WIDTH)}))"


def again(failed: str, level: int) -> str:
    """SQL for the blocks of ``failed``, an array of struct(a, b), each tried as four with other cell positions."""
    return f"flatten(transform({failed}, f -> {tried('f.a', 'f.b', '2', '2', level)}))"


def _failed(blocks: str) -> str:
    return f"transform(filter({blocks}, f -> NOT f.p.ok), f -> named_struct('a', f.a, 'b', f.b))"


def _peeled(blocks: str, c: str) -> str:
    return f"flatten(transform(filter({blocks}, f -> f.p.ok), f -> f.p.{c}))"


def with_difference(rows: DataFrame, a: str, b: str, pair: int, per_differing: int) -> DataFrame:
    """``rows`` with more_<pair>, less_<pair> and left_<pair> for the digest arrays ``a`` and ``b``,
    whose subtracted fingerprints gave p<pair>. If these were too small, both are sketched in as
    many blocks as their sizes call for, if one of ``per_differing`` digests differs, and blocks that fail once more in four, all in the row.
    ``left`` has the few blocks that fail even then."""
    none = "array()"
    sized, fours, side, blocks = (f"{name}_{pair}" for name in ("sized", "fours", "side", "blocks"))
    rows = rows.withColumn(blocks, F.expr(f"greatest(1, ceil((size({a}) + size({b})) / {BLOCK_KEYS * per_differing}))"))
    rows = rows.withColumn(side, F.expr(f"cast(ceil(sqrt({blocks})) AS int)")).withColumn(blocks, F.expr(f"cast(ceil({blocks} / {side}) AS int)"))
    rows = rows.withColumn(sized, F.expr(f"if(p{pair}.ok, NULL, {tried(a, b, side, blocks, 1)})"))
    rows = rows.withColumn(fours, F.expr(f"if(p{pair}.ok, NULL, {again(_failed(sized), 2)})"))
    found = [F.expr(f"if(p{pair}.ok, p{pair}.{c}, concat({_peeled(sized, c)}, {_peeled(fours, c)}))").alias(f"{c}_{pair}") for c in ("more", "less")]
    return rows.select("*", *found, F.expr(f"if(p{pair}.ok, {none}, {_failed(fours)})").alias(f"left_{pair}")).drop(sized, fours, side, blocks)


def differences(failed: DataFrame, level: int = 3) -> DataFrame | None:
    """(row, pair, more, less) of a table (row, pair, a, b) of blocks that have failed ``level`` - 1
    times: four for each, then four for each of those that still fails, until none is left. A pair
    has a row for each of its parts that was peeled; None if there is nothing to do."""
    done: list[DataFrame] = []
    while not failed.isEmpty():
        blocks = failed.withColumn("fours", F.expr(tried("a", "b", "2", "2", level)))
        found = [F.expr(_peeled("fours", c)).alias(c) for c in ("more", "less")]
        blocks = written(blocks.select("row", "pair", *found, F.expr(_failed("fours")).alias("failed")))
        done.append(blocks.select("row", "pair", "more", "less"))
        failed = blocks.select("row", "pair", F.explode("failed").alias("f")).select("row", "pair", "f.a", "f.b")
        level += 1
    return reduce(DataFrame.union, done) if done else None


def _bucket(bounds: list[int]) -> Column:
    """The number of bounds below the id, by bisection."""
    if not bounds:
        return F.lit(0)
    table = F.lit(bounds)
    steps = len(bounds).bit_length()
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))

    def step(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        below = (s["lo"] < s["hi"]) & (F.get(table, mid) < F.col("doc_id"))
        return F.struct(F.when(below, mid + 1).otherwise(s["lo"]).alias("lo"), F.when(below | (s["lo"] >= s["hi"]), s["hi"]).otherwise(mid).alias("hi"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step, lambda s: s["lo"])


def beside_next(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(doc_id, text) with its digests and sketch (a, ca), and next_text, b, cb: those of the next
    document by descending id; after the last comes the first.

    Ids are dealt into ranges. Each range also gets a copy of the first document of the range
    below, so that every document has its next one beside it in its range.
    """
    docs = docs.where("doc_id is not null").withColumn("version", F.xxhash64("text"))
    count = docs.count()
    cuts = min(1 << 16, -(-count // range_rows)) - 1
    bounds: list[int] = []
    if cuts > 0:
        bounds = sorted(set(docs.agg(F.percentile_approx("doc_id", [i / (cuts + 1) for i in range(1, cuts + 1)], max(10_000, 20 * cuts))).first()[0]))
    docs = docs.withColumn("range", _bucket(bounds))
    tops = sorted((r["range"], r["top"]) for r in docs.groupBy("range").agg(F.max("doc_id").alias("top")).collect())  # one row per range
    if not tops:
        tops = [(0, 0)]
    below = [(tops[i - 1][1], r) for i, (r, _) in enumerate(tops)]  # the lowest range gets the highest one's first document
    heads = F.broadcast(docs.sparkSession.createDataFrame(below, "doc_id long, above int"))
    heads = docs.join(heads, "doc_id").withColumn("nth", F.row_number().over(Window.partitionBy("above").orderBy(F.desc("version")))).where("nth = 1")
    heads = heads.select("doc_id", "text", "version", F.col("above").alias("range"), F.lit(True).alias("copy"))
    order = Window.partitionBy("range").orderBy("copy", F.desc("doc_id"), F.desc("version"))
    dealt = docs.select("doc_id", "text", "version", "range", F.lit(False).alias("copy")).union(heads)
    # digests and sketches are made once per text, after it has moved
    dealt = dealt.repartition("range").withColumn("a", paragraphs(F.col("text"))).withColumn("ca", F.expr(sketch("a")))
    ahead = [F.lead(c).over(order).alias(n) for c, n in (("text", "next_text"), ("a", "b"), ("ca", "cb"))]
    return dealt.select("doc_id", "text", "a", "ca", "copy", *ahead).where("not copy").drop("copy")


def fingerprint_versions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, and only_text, only_edited, the sorted digests of the paragraphs that
    one version has alone.

    The edited text has the last floor(n_chars / 3) code points replaced by as many from the
    front of the next document (all if it has fewer), by descending id; after the last comes the
    first. Likeness is |common| / |all| paragraphs, 1 if both have none, from the difference
    that peeling recovers. A null text is empty. Rows that repeat an id follow each other by a
    hash of the text. A row with a null id has no place in the order: its next document is an
    empty one. An only document is its own next one. An empty table gives an empty result.
    """
    docs = two_columns(docs, id_col, text_col)
    none = docs.where("doc_id is null").withColumn("a", paragraphs(F.col("text"))).withColumn("b", paragraphs(F.lit("")))
    none = none.select("doc_id", "text", "a", F.expr(sketch("a")).alias("ca"), F.lit("").alias("next_text"), "b", F.expr(sketch("b")).alias("cb"))
    rows = beside_next(docs).union(none).withColumn("n_chars", F.length("text").cast("long"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - third).cast("int")), F.substring("next_text", F.lit(1), third))
    rows = rows.withColumn("edited", edited).withColumn("e", paragraphs(F.col("edited"))).withColumn("ce", F.expr(sketch("e")))
    rows = rows.withColumn("p0", F.expr(peel(subtract("ca", "ce")))).withColumn("p1", F.expr(peel(subtract("ca", "cb"))))
    rows = with_difference(with_difference(rows, "a", "e", 0, VERSIONS), "a", "b", 1, DOCUMENTS)
    # of the two versions the digests count, of the next document their number
    rows = written(
        rows.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "n_chars",
            F.unhex(F.sha2("edited", 256)).alias("edited_sha256"),
            packed_cells("ca").alias("cells"),
            packed_cells("ce").alias("edited_cells"),
            F.size("a").alias("size"),
            F.size("e").alias("edited_size"),
            F.col("more_0").alias("only_more"),
            F.col("less_0").alias("only_less"),
            F.size("more_1").alias("more_1"),
            F.size("less_1").alias("less_1"),
            F.expr("concat(transform(left_0, f -> named_struct('pair', 0, 'a', f.a, 'b', f.b)), transform(left_1, f -> named_struct('pair', 1, 'a', f.a, 'b', f.b)))").alias("left"),
        )
    )
    # few rows are left, and only these meet the digests of their last blocks
    out = rows.where(F.size("left") == 0).drop("left", "row")
    found = differences(rows.select("row", F.explode("left").alias("f")).select("row", "f.*"))
    if found is not None:
        part = lambda p, c: F.when(F.col("pair") == p, F.col(c))
        found = found.groupBy("row").agg(
            *(F.flatten(F.collect_list(part(0, c))).alias(f"last_{c}_0") for c in ("more", "less")),
            *(F.coalesce(F.sum(F.size(part(1, c))), F.lit(0)).cast("int").alias(f"last_{c}_1") for c in ("more", "less")),
        )
        late = rows.where(F.size("left") > 0).drop("left").join(found, "row")
        for c in ("more", "less"):
            late = late.withColumn(f"only_{c}", F.concat(f"only_{c}", f"last_{c}_0")).withColumn(f"{c}_1", F.col(f"{c}_1") + F.col(f"last_{c}_1"))
        out = out.union(late.select(out.columns))
    for c in ("more", "less"):
        out = out.withColumn(f"only_{c}", F.array_sort(f"only_{c}")).withColumn(f"{c}_0", F.size(f"only_{c}"))

    def likeness(p: int) -> Column:
        common, every = F.col("size") - F.col(f"more_{p}"), F.col("size") + F.col(f"less_{p}")
        return F.when(every == 0, 1.0).otherwise(common / F.when(every > 0, every))

    prints = [written_form(size, cells).alias(name) for size, cells, name in (("size", "cells", "fingerprint"), ("edited_size", "edited_cells", "edited_fingerprint"))]
    return out.select("doc_id", "n_chars", F.lower(F.hex("edited_sha256")).alias("edited_sha256"), *prints, likeness(0).alias("near_edited"), likeness(1).alias("near_next"), F.col("only_more").alias("only_text"), F.col("only_less").alias("only_edited"))
