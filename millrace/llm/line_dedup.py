"""Repeated runs of lines by winnowing over line hashes.

1. *Windows.* The lines of a document that hold words are hashed. A window starts at each of
   them and spans the fewest lines that hold ``min_words`` words, so that every run of that many
   words holds a window.
2. *Winnowing.* Of each window the line with the smallest hash is selected (of equal ones the
   last). Neighbouring windows mostly select the same line, which then is one fingerprint:
   only these thinned positions are counted. A run that two documents share has a window in
   common, and so a fingerprint: none is missed.
3. *Join.* Positions are joined on fingerprints that stand more than once. The windows around
   such a position, those that selected it, are matched with the first place of the same lines;
   where neighbouring windows match, the match grows to the left and to the right.
4. *Extension.* Beyond the last window that matches, fewer than ``min_words`` words can be left
   of a run. Each matched window is extended line by line as far as the next window reaches,
   and the longest extension that stands earlier counts (``whole_runs``).
5. *Deletion.* Of every repeated run only the first occurrence stays.

Lines and runs are equal if two differently seeded 64-bit hashes are, 128 bits together.

Only hashes and positions are shuffled. Groups are reduced to a count and a first place, which
combine before the shuffle, and keys with more than a thousandth of the rows are joined by
broadcast, so a line that a third of all documents share is no hot spot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import WORD, joined, written

#: Words of a run that count as a repetition.
MIN_WORDS = 10


def _content(members: Column) -> list[Column]:
    return [F.xxhash64(members["h"]).alias("c1"), F.xxhash64(members["g"]).alias("c2")]


def windows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per window of a table (doc, version, text): its lines (line to last), the selected
    one and its hash (position, fingerprint), whether the window is the first that selected it
    (head), its content (c1, c2), and the contents of its extensions."""
    # rows that are alike are one document here
    docs = docs.groupBy("doc", "version").agg(F.any_value("text").alias("text"))
    lines = docs.select("doc", "version", F.posexplode(F.split("text", "\n", -1)).alias("line", "content"))
    lines = lines.select("doc", "version", "line", F.xxhash64("content").alias("h"), F.xxhash64(F.lit(1), "content").alias("g"), F.regexp_count("content", F.lit(WORD)).alias("words")).where("words > 0")
    along = Window.partitionBy("doc", "version").orderBy("line")
    lines = lines.withColumn("begin", F.sum("words").over(along) - F.col("words"))
    # the lines that begin within min_words words of this one's beginning
    ahead = Window.partitionBy("doc", "version").orderBy("begin").rangeBetween(0, min_words - 1)
    lines = lines.withColumn("ahead", F.collect_list(F.struct("h", "g", "line", "words")).over(ahead))
    lines = lines.withColumn("next", F.coalesce(F.lead("ahead").over(along), F.slice("ahead", 1, 0)))
    least = F.array_min(F.transform("ahead", lambda m: F.struct(m["h"].alias("h"), (-m["line"]).alias("at"))))
    full = F.aggregate(F.col("ahead")["words"], F.lit(0), lambda n, w: n + w) >= min_words
    rows = lines.where(full).select("doc", "version", "line", "ahead", F.array_max(F.col("ahead")["line"]).alias("last"), F.filter("next", lambda m: m["line"] > F.array_max(F.col("ahead")["line"])).alias("beyond"), least.alias("least"))

    def extended(_: Column, i: Column) -> Column:
        members = F.concat("ahead", F.slice("beyond", 1, i + 1))
        return F.struct(F.get("beyond", i)["line"].alias("last"), *_content(members))

    position = -F.col("least.at")
    head = ~F.lag(position).over(along).eqNullSafe(position)
    return rows.select("doc", "version", "line", "last", position.alias("position"), F.col("least.h").alias("fingerprint"), head.alias("head"), *_content(F.col("ahead")), F.transform("beyond", extended).alias("extensions"))


def _first_places(runs: DataFrame) -> DataFrame:
    """(c1, c2, first, n) of the contents that more than one run has."""
    return runs.groupBy("c1", "c2").agg(F.min(F.struct("doc", "version", "line", "last")).alias("first"), F.count("*").alias("n")).where("n > 1")


def _later(runs: DataFrame) -> DataFrame:
    """(doc, version, from, last) of the runs that are not the first of their content. One that
    overlaps the first one in its own document spares the first one's lines."""
    own = (F.col("first.doc") == F.col("doc")) & (F.col("first.version") == F.col("version"))
    later = runs.where(F.struct("doc", "version", "line", "last") > F.col("first"))
    later = later.withColumn("from", F.when(own, F.greatest(F.col("line"), F.col("first.last") + 1)).otherwise(F.col("line")))
    return later.where("from <= last").select("doc", "version", "from", "last")


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, whole_runs: bool = False) -> DataFrame:
    """(doc, version, line): the lines to delete, of a table (doc, version, text)."""
    every = written(windows(docs, min_words))
    shared = every.where("head").groupBy("fingerprint").agg(F.count("*").alias("n")).where("n > 1")
    around = written(joined(every, shared, ["fingerprint"]).select("doc", "version", "line", "last", "c1", "c2", "extensions"))
    matched = joined(around, _first_places(around), ["c1", "c2"]).drop("c1", "c2", "n")
    if whole_runs:
        matched = written(matched)
        runs = matched.select("doc", "version", "line", F.inline("extensions"))
        later = _later(matched).union(_later(joined(runs, _first_places(runs), ["c1", "c2"])))
    else:
        later = _later(matched)
    return later.select("doc", "version", F.explode(F.sequence("from", "last")).alias("line"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, whole_runs: bool = False) -> DataFrame:
    """``docs`` with later repeated runs cut out of the text, and two more columns: n_lines and n_deleted.

    Lines are separated by U+000A; words are runs of characters other than space and U+0009 to
    U+000D. A line is deleted if it is in a window (see above) that equals an earlier one, by
    (id, line): lines without words don't count in a window, and go only from inside a deleted
    one. With ``whole_runs`` matches are extended, so that a line is deleted if it is in any run
    of lines with words that holds min_words words and stands earlier, however the texts go on.
    A run that overlaps its first occurrence in the same document leaves that whole.
    Rows that repeat an id with other texts are documents of their own in the order of a text
    hash; rows alike in id and text are one document and lose the same lines. Null ids come
    last. A null text stays null (n_lines null, n_deleted 0), an empty one has one line. Other
    columns, whatever their names, are kept as they are. An empty table gives an empty result.
    """
    doc, version = F.col(id_col).cast("long"), F.xxhash64(F.col(text_col))
    # a null id counts as the largest one, in versions that come after that id's own: its sign bit tells them apart
    version = F.when(doc.isNull(), version.bitwiseAND((1 << 63) - 1)).otherwise(version.bitwiseOR(-(1 << 63)))
    key = F.coalesce(doc, F.lit((1 << 63) - 1)).alias("doc"), version.alias("version")
    marked = repeated_lines(docs.where(F.col(text_col).isNotNull()).select(*key, F.col(text_col).alias("text")), min_words, whole_runs)
    marks = marked.groupBy("doc", "version").agg(F.array_sort(F.collect_set("line")).alias("marks"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), *key).join(marks, ["doc", "version"], "left")
    lines = F.split(F.col("row")[text_col], "\n", -1)
    # the lines between one mark and the next, for all marks
    rows = rows.withColumn("lines", lines).withColumn("cuts", F.concat(F.array(F.lit(-1)), "marks", F.array(F.size("lines"))))
    kept = F.expr("flatten(transform(sequence(1, size(cuts) - 1), j -> slice(lines, cuts[j - 1] + 2, cuts[j] - cuts[j - 1] - 1)))")
    text = F.when(F.col("marks").isNull(), F.col("row")[text_col]).otherwise(F.array_join(kept, "\n"))
    columns = [(text if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns if c not in ("n_lines", "n_deleted")]
    n_lines = F.when(F.col("row")[text_col].isNotNull(), F.size("lines")).cast("long")
    return rows.select(*columns, n_lines.alias("n_lines"), F.when(F.col("marks").isNull(), 0).otherwise(F.size("marks")).cast("long").alias("n_deleted"))


#: What ``dedup_lines`` with ``whole_runs`` returns on (doc_id, text) of the table documents, in
#: DuckDB's SQL: every run of lines that holds ten words, and fewer without its two ends, is
#: compared by its text, without windows, minima or hashes.
LINES_SQL = """
WITH t AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
e AS (SELECT doc_id, unnest(lines) AS content, unnest(range(len(lines))) AS line FROM t WHERE text IS NOT NULL),
w AS (SELECT *, len(regexp_extract_all(content, '[^\\x20\\x09-\\x0D]+')) AS words FROM e),
b AS (SELECT *, row_number() OVER o AS k, sum(words) OVER o AS upto FROM w WHERE words > 0 WINDOW o AS (PARTITION BY doc_id ORDER BY line)),
c AS (SELECT doc_id, list(content ORDER BY line) AS held FROM b GROUP BY doc_id),
r AS (
  SELECT a.doc_id, a.line AS begin, z.line AS last, array_to_string(held[a.k:z.k], chr(10)) AS content
  FROM b AS a JOIN b AS z ON a.doc_id = z.doc_id AND z.k >= a.k AND z.upto - (a.upto - a.words) >= %(n)d AND (z.upto - z.words) - a.upto < %(n)d
  JOIN c ON c.doc_id = a.doc_id),
f AS (SELECT *, first_value(doc_id) OVER o AS first_doc, first_value(begin) OVER o AS first_begin, first_value(last) OVER o AS first_last
      FROM r WINDOW o AS (PARTITION BY content ORDER BY doc_id, begin)),
g AS (SELECT DISTINCT doc_id, unnest(range(CASE WHEN doc_id = first_doc THEN greatest(begin, first_last + 1) ELSE begin END, last + 1)) AS line
      FROM f WHERE doc_id > first_doc OR begin > first_begin),
k AS (SELECT e.doc_id, string_agg(e.content, chr(10) ORDER BY e.line) FILTER (g.line IS NULL) AS kept, count(g.line) AS n
      FROM e LEFT JOIN g ON e.doc_id = g.doc_id AND e.line = g.line GROUP BY e.doc_id)
SELECT t.doc_id, CASE WHEN t.text IS NOT NULL THEN coalesce(k.kept, '') END AS text,
       CAST(len(t.lines) AS BIGINT) AS n_lines, CAST(coalesce(k.n, 0) AS BIGINT) AS n_deleted
FROM t LEFT JOIN k ON k.doc_id = t.doc_id
""" % {"n": MIN_WORDS}
