"""Personal data: fixed patterns, and contextual extraction bootstrapped from them.

One pass over the texts finds the spans of the fixed patterns (the seed entities) and other
tokens that look like identifiers, each with its lexical contexts: the two words before it,
and the word before and the word after. Only these leave the pass. Contexts and values form
a graph. In each round a context's score is the mean score of its distinct values (seeds
count 1), shrunk towards 0 where there are few, and a value's score is the chance that at
least one of its confident contexts is right. Values found that way count in the next round;
scores never fall, and the rounds end when they no longer rise.
Distinct values are counted, so a document that is copied a thousand times counts once.

DataFrame functions only. Groups are reduced to sums, which combine before the shuffle, and
values or contexts with more than a thousandth of the edges are joined by broadcast. What is
done for one text grows in proportion to its length, whatever it holds.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import joined, two_columns, written

#: Fixed patterns. Possessive quantifiers and look-behinds keep the scan linear and change no match.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
#: A whole sequence of digits and single separators, if it has 16 to 19 digits.
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
#: A token with five digits or an @.
TOKEN = r"(?<!\S)(?:(?:[^\s0-9]*+[0-9]){5}|[^\s@]*+@)\S*+"
PART = "^0*([0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"
KINDS = ("email", "ip", "card", "phone")

#: Distinct values of a context at least, and the score from which it extracts.
MIN_VALUES, MIN_CONTEXT = 4, 0.75
#: Spans whose places are summed up one by one.
CHUNK = 64


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def _placed(pairs: Column) -> Column:
    """array of (value, begin, end) of an array of (before, m): running sums of lengths, over
    chunks first and then inside each, so that no array grows with all spans of a text."""
    length = lambda n, x: n + F.length(x["before"]) + F.length(x["m"])
    n_chunks = F.ceil(F.size(pairs) / CHUNK).cast("int")
    chunks = F.transform(F.slice(F.sequence(F.lit(0), n_chunks), 1, n_chunks), lambda c: F.slice(pairs, c * CHUNK + 1, F.lit(CHUNK)))

    def inside(chunk: Column, at: Column) -> Column:
        start = F.struct(at.alias("at"), F.expr("cast(array() as array<struct<value:string,begin:int,end:int>>)").alias("found"))

        def step(acc: Column, x: Column) -> Column:
            begin = acc["at"] + F.length(x["before"])
            end = begin + F.length(x["m"])
            return F.struct(end.alias("at"), F.concat(acc["found"], F.array(F.struct(x["m"].alias("value"), begin.alias("begin"), end.alias("end")))).alias("found"))

        return F.aggregate(chunk, start, step, lambda acc: acc["found"])

    def starts(parts: Column) -> Column:
        sums = F.transform(parts, lambda c: F.aggregate(c, F.lit(0), length))
        return F.aggregate(sums, F.array(F.lit(0)), lambda at, n: F.concat(at, F.array(F.element_at(at, -1) + n)))

    return _let(chunks, lambda parts: F.flatten(F.zip_with(parts, F.slice(starts(parts), 1, F.size(parts)), inside)))


def spans(text: Column, pattern: str) -> Column:
    """array of (value, begin, end, left, right): the leftmost non-overlapping matches in code
    points, and the text on either side as far as the second or third match from there.

    What lies between the matches is what split() gives.
    """
    match = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    got = F.struct(match.alias("m"), F.split(text, pattern, -1).alias("b"))

    def around(r: Column) -> Column:
        part = lambda name, i: F.coalesce(F.get(r[name], i), F.lit(""))

        def with_sides(s: Column, i: Column) -> Column:
            left = F.concat(part("m", i - 2), part("b", i - 1), part("m", i - 1), part("b", i))
            left = F.concat(part("b", i - 2), left)
            right = F.concat(part("b", i + 1), part("m", i + 1), part("b", i + 2), part("m", i + 2), part("b", i + 3))
            return F.struct(s["value"], s["begin"], s["end"], left.alias("left"), right.alias("right"))

        pairs = F.zip_with(r["m"], F.slice(r["b"], 1, F.size(r["m"])), lambda m, b: F.struct(b.alias("before"), m.alias("m")))
        return F.transform(_let(pairs, _placed), with_sides)

    return _let(got, around)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when((F.length(digits) - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _empty_if(condition: Column, found: Column) -> Column:
    none = F.expr("cast(array() as array<struct<value:string,begin:int,end:int,left:string,right:string>>)")
    return F.when(condition, found).otherwise(none)


def _overlap(spans: Column, s: Column) -> Column:
    """Does one of a kind's spans, which are in order and apart, overlap this one? By bisection."""
    start = F.struct(F.lit(0).alias("lo"), F.size(spans).alias("hi"))

    def step(r: Column, _: Column) -> Column:
        mid = F.floor((r["lo"] + r["hi"]) / 2).cast("int")
        before = (r["lo"] < r["hi"]) & (F.get(spans, mid)["begin"] < s["end"])
        return F.struct(F.when(before, mid + 1).otherwise(r["lo"]).alias("lo"), F.when(before, r["hi"]).otherwise(mid).alias("hi"))

    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(spans) + 1)).cast("int") + 1)
    last = F.aggregate(steps, start, step, lambda r: F.get(spans, r["lo"] - 1)["end"])
    return F.when(F.size(spans) == 0, False).otherwise(F.coalesce(last > s["begin"], F.lit(False)))


def _any(conditions: Iterable[Column]) -> Column:
    return reduce(Column.__or__, conditions)


def base_spans(text: Column) -> dict[str, Column]:
    """kind -> its spans; matches that fail their kind's condition are dropped."""
    return {
        "email": _empty_if(F.instr(text, "@") > 0, spans(text, EMAIL)),
        "ip": F.filter(_empty_if(text.rlike(r"[0-9]\.[0-9]"), spans(text, IP)), lambda s: F.forall(F.split(s["value"], r"\."), lambda p: p.rlike(PART))),
        "card": F.filter(_empty_if(text.rlike("[0-9][ -]?[0-9][ -]?[0-9]"), spans(text, CARD)), lambda s: _luhn(_digits(s["value"]))),
        "phone": F.filter(_empty_if(F.instr(text, "+") > 0, spans(text, PHONE)), lambda s: F.length(_digits(s["value"])).between(8, 15)),
    }


def _contexts(left: Column, right: Column) -> Column:
    """Up to two contexts of a span, words lower-cased, digits as 0."""
    plain = lambda c: F.regexp_replace(F.regexp_replace(F.lower(c), r"\s+", " "), "[0-9]+", "0")
    before, after = F.rtrim(plain(left)), F.substring_index(plain(right), " ", 2)
    two, one = F.ltrim(F.substring_index(before, " ", -2)), F.substring_index(before, " ", -1)
    word = F.when(F.contains(after, F.lit(" ")), F.substring_index(after, " ", -1)).otherwise("")
    both = F.concat(one, F.lit(" _ "), word)
    return F.filter(F.array(F.when(F.contains(two, F.lit(" ")), F.concat(two, F.lit(" _"))), F.when((one != "") & (word != ""), both)), lambda c: c.isNotNull())


def discovered(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """(value) of the values that are no seeds and that contexts name with a score of MIN_CONTEXT,
    of a table (context, value, seed) of distinct edges. ``rounds``: so many at most."""
    degrees = written(edges.groupBy("context").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_VALUES))
    values = written(edges.groupBy("value").agg(F.max("seed").alias("seed"), F.count("*").alias("n")))
    seeds = values.where("seed").select("value", F.lit(1.0).alias("score"), "n")
    found = seeds.limit(0)
    before, done = None, 0
    while rounds is None or done < rounds:
        sums = joined(edges, seeds.union(found), ["value"]).groupBy("context").agg(F.sum("score").alias("s"))
        contexts = degrees.join(sums, "context").select("context", (F.col("s") / (F.col("n") + 1)).alias("confidence"), "n").where(F.col("confidence") >= MIN_CONTEXT)
        doubts = joined(edges.where("not seed"), contexts, ["context"]).groupBy("value").agg(F.sum(F.log(1 - F.col("confidence"))).alias("doubt"))
        found = written(values.where("not seed").join(doubts, "value").select("value", (1 - F.exp("doubt")).alias("score"), "n"))
        # scores only rise; a round in which none does by a hundredth is the last one
        now = tuple(found.agg(F.count("*"), F.sum(F.floor(F.col("score") * 100))).first())
        done += 1
        if now == before or not now[0]:
            break
        before = now
    return found.where(F.col("score") >= MIN_CONTEXT).select("value")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, n_context, base_sha256, spans.

    ``spans`` lists kind:start:end, comma-joined, by kind (the four fixed ones, then context)
    and start, in code points, end exclusive; base_sha256 digests the fixed kinds' part of it.
    A context span is a token with at least five digits, or with a digit and an @, that no fixed
    span overlaps and whose value the rounds found (``rounds``: so many at most). A null text is empty and has none. Rows that
    repeat an id get a row each; a null id stays null; other columns are not looked at. An empty
    table gives an empty result.
    """
    docs = two_columns(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    text = F.col("text")
    found = docs.where(text.rlike("[0-9@]")).select("doc_id", "row", "text", *(c.alias(k) for k, c in base_spans(text).items()), spans(text, TOKEN).alias("tokens"))
    known = F.concat(*KINDS)
    head, tail = r"^[\"'(\[<{=:]++", r"(?<![.,;:!?\"')\]>}%&$#*])[.,;:!?\"')\]>}%&$#*]++$"
    trimmed = F.transform("tokens", lambda s: F.struct(s["begin"], s["left"], s["right"], F.regexp_extract(s["value"], head, 0).alias("head"), F.regexp_extract(F.regexp_replace(s["value"], head, ""), tail, 0).alias("tail"), s["value"].alias("token")))

    def cut(s: Column) -> Column:
        size = F.length(s["token"]) - F.length(s["head"]) - F.length(s["tail"])
        begin = s["begin"] + F.length(s["head"])
        value = F.substring(s["token"], F.length(s["head"]) + 1, size)
        return F.struct(value.alias("value"), begin.alias("begin"), (begin + size).alias("end"), F.concat(s["left"], s["head"]).alias("left"), F.concat(s["tail"], s["right"]).alias("right"))

    placed = F.transform(trimmed, cut)
    n_digits = lambda s: F.length(_digits(s["value"]))
    other = F.filter(placed, lambda s: ((n_digits(s) >= 5) | ((n_digits(s) >= 1) & (F.instr(s["value"], "@") > 0))) & ~_any(_overlap(F.col(k), s) for k in KINDS))
    tagged = lambda c, seed: F.transform(c, lambda s: F.struct(s["begin"], s["end"], F.xxhash64(F.lower(s["value"])).alias("value"), F.lit(seed).alias("seed"), _contexts(s["left"], s["right"]).alias("contexts")))
    strip = lambda k: F.transform(k, lambda s: F.struct(s["begin"], s["end"])).alias(k)
    found = found.withColumn("known", known).withColumn("other", other)
    found = written(found.select("doc_id", "row", *map(strip, KINDS), F.concat(tagged("known", True), tagged("other", False)).alias("entities")))

    entities = found.select("row", F.explode("entities").alias("e")).select("row", "e.*")
    edges = written(entities.select("value", "seed", F.explode("contexts").alias("context")).groupBy("context", "value").agg(F.max("seed").alias("seed")))
    other = entities.where("not seed").select("value", "row", "begin", "end")
    sure = other.groupBy("value").agg(F.count("*").alias("n")).join(discovered(edges, rounds), "value")
    fresh = joined(other, sure, ["value"]).groupBy("row").agg(F.array_sort(F.collect_set(F.struct("begin", "end"))).alias("context"))
    found = found.join(fresh, "row", "left")
    none = F.expr("cast(array() as array<struct<begin:int,end:int>>)")
    found = found.withColumn("context", F.coalesce("context", none))
    words = lambda k: F.transform(k, lambda s: F.concat_ws(":", F.lit(k), s["begin"], s["end"]))
    base = F.array_join(F.concat(*map(words, KINDS)), ",")
    every = F.array_join(F.concat(*map(words, (*KINDS, "context"))), ",")
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in (*KINDS, "context")]
    empty = [F.lit(0).cast("long").alias(f"n_{k}") for k in (*KINDS, "context")]
    rest = docs.where(~text.rlike("[0-9@]")).select("doc_id", *empty, F.sha2(F.lit(""), 256).alias("base_sha256"), F.lit("").alias("spans"))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), every.alias("spans")).union(rest)
