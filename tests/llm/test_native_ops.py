"""Line dedup, mixing, fingerprints and personal data against brute force; no Python in their plans."""

import hashlib
import random
import re

import duckdb
import pytest
from helpers import AWKWARD, SF, WORD, awkward, documents, empty

from millrace.llm.fingerprints import PIECE, fingerprint_versions
from millrace.llm.line_dedup import dedup_lines
from millrace.llm.mixing import MIX_SQL, mix, targets
from millrace.llm.pii import find_pii


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not re.search("Python|Pandas|Arrow", plan)


# --- lines --------------------------------------------------------------------------------


def brute_lines(rows, min_words=10):
    first, windows, gone = {}, [], {}
    for d, t in sorted(rows):
        lines = t.split("\n")
        worded = [(i, n) for i, n in ((i, len(WORD.findall(x))) for i, x in enumerate(lines)) if n]
        gone[d] = set()
        for a in range(len(worded)):
            n, b = 0, a
            while b < len(worded) and n < min_words:
                n, b = n + worded[b][1], b + 1
            if n >= min_words:
                content, begin, last = tuple(lines[i] for i, _ in worded[a:b]), worded[a][0], worded[b - 1][0]
                first.setdefault(content, (d, begin, last))
                windows.append((content, d, begin, last))
    for content, d, begin, last in windows:
        fd, fbegin, flast = first[content]
        if (fd, fbegin) < (d, begin):
            gone[d] |= set(range(max(begin, flast + 1) if fd == d else begin, last + 1))
    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]) for d, t in rows}


def test_lines_of_the_tables(spark):
    docs = documents(spark)
    got = dedup_lines(docs)
    assert no_python(got) and {r.doc_id: r.text for r in got.collect()} == brute_lines([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("seed", range(3))
def test_lines_at_random(spark, seed):
    rng = random.Random(seed)
    pool = [" ".join(f"p{i}w{j}" for j in range(rng.choice([0, 1, 3, 5, 12, 60]))) for i in range(25)]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(0, 14)))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.text for r in dedup_lines(df).collect()} == brute_lines(rows)


def test_awkward_lines(spark):
    df = awkward(spark)
    got = dedup_lines(df)
    assert got.columns == [*df.columns, "n_lines", "n_deleted"] and got.count() == df.count()
    rows = got.collect()
    assert all(r.line == "x" and r.marks == "x" for r in rows)
    assert [r.text for r in rows if r.doc_id == 3] == [None] and [r.n_lines for r in rows if r.doc_id == 4] == [1]
    assert dedup_lines(empty(spark)).count() == 0


# --- mixing -------------------------------------------------------------------------------


def test_mix_against_sql(spark):
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = mix(documents(spark))
    want = c.execute(MIX_SQL)
    names = [d[0] for d in want.description]
    assert no_python(got) and sorted(tuple(r) for r in got.select(*names).collect()) == sorted(want.fetchall())


def test_mix_holds_targets(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), rng.choice(["a"] * 8 + ["b", "c", None])) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix(df, cell_rows=50).collect()
    assert len(got) == 3000 and all(r.taken in (0, r.size, 2 * r.size) for r in got)
    by = {}
    for r in got:
        by.setdefault((r.source_size, r.target), []).append(r.taken)
    total = sum(size for size, _ in by)
    assert abs(sum(t for _, t in by) - 1.5 * total) < 1e-6 * total
    assert all(abs(sum(v) - t) <= 130 and t <= 2 * s + 1e-9 for (s, t), v in by.items())
    assert sorted(map(tuple, got)) == sorted(tuple(r) for r in mix(df.repartition(7), cell_rows=50).collect())


def test_targets_fill_to_the_cap(spark):
    df = spark.createDataFrame([("a", 0, 10), ("b", 1, 1000), ("c", 2, 500)], "source string, source_rank int, source_size long")
    got = {r.source: r.target for r in targets(df).collect()}
    assert got["a"] == 20 and abs(sum(got.values()) - 1.5 * 1510) < 1e-9 and abs(got["b"] - 2 * got["c"]) < 1e-6


def test_awkward_mix(spark):
    rows = mix(awkward(spark)).collect()
    assert len(rows) == 13 and {r.taken for r in rows if r.size == 0} == {0}
    assert mix(empty(spark)).count() == 0
    blank = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [r.taken for r in mix(blank).collect()] == [0, 0]


# --- fingerprints -------------------------------------------------------------------------


def pieces(t):
    return set(re.findall(PIECE, t))


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute_versions(rows):
    rows = sorted(rows, reverse=True)
    out = {}
    for i, (d, t) in enumerate(rows):
        nxt, k = rows[(i + 1) % len(rows)][1], len(t) // 3
        e = t[: len(t) - k] + nxt[:k]
        out[d] = (len(t), hashlib.sha256(e.encode()).hexdigest(), likeness(pieces(t), pieces(e)), likeness(pieces(t), pieces(nxt)))
    return out


def test_versions_of_the_tables(spark):
    docs = documents(spark)
    got = fingerprint_versions(docs)
    assert no_python(got)
    rows = {r.doc_id: (r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got.collect()}
    want = brute_versions([(r.doc_id, r.text) for r in docs.collect()])
    assert rows.keys() == want.keys()
    for d, w in want.items():
        assert rows[d][:2] == w[:2] and rows[d][2:] == pytest.approx(w[2:])


def test_equal_texts_have_equal_fingerprints(spark):
    text = "\n".join(f"line {i} of a text" for i in range(300))
    rows = [(i * 10**12, text if i % 2 else text.replace("7", "8")) for i in range(6)]
    got = fingerprint_versions(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    prints = {r.doc_id: r.fingerprint for r in got}
    assert len(set(prints.values())) == 2 and prints[0] == prints[2 * 10**12]
    assert {r.doc_id: pytest.approx(r.near_next) for r in got} == {d: w[3] for d, w in brute_versions(rows).items()}


def test_awkward_versions(spark):
    df = awkward(spark)
    rows = fingerprint_versions(df).collect()
    assert len(rows) == df.count()
    by = {r.doc_id: r for r in rows}
    assert by[3].n_chars == 0 and by[3].fingerprint == by[4].fingerprint and by[9].n_chars == len(AWKWARD[11][1])
    assert fingerprint_versions(empty(spark)).count() == 0
    one = fingerprint_versions(spark.createDataFrame([(5, "abc def")], "doc_id long, text string")).first()
    assert (one.near_next, one.edited_sha256) == (1.0, hashlib.sha256(b"abc dab").hexdigest())


# --- personal data ------------------------------------------------------------------------

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    doubled = [int(c) * 2 if i % 2 else int(c) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


def brute_pii(t):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in _EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in _IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in _CARD.finditer(t) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", *m.span()) for m in _PHONE.finditer(t) if 8 <= len(digits(m)) <= 15]
    return ",".join(f"{k}:{a}:{b}" for k, a, b in out)


HARD = ["a@b.com_x@y.com é😀 z@q.org", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4", "4111 1111 1111 1111 1 4111-1111-1111-1111", "+1 (555) 123-4567 +12345678901234567 +1-2", "4111  1111 1111 1111 1111 1111 ", " ".join(["12"] * 4000), "9" * 30000, "a" * 30000 + "@b.c", ".@a.b a.b@c", "x" * 50000, "+1" + " " * 20000 + "2 tel +49 30 1234567"]


def test_pii_against_regexes(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()] + [(10**6 + i, t) for i, t in enumerate(HARD)]
    got = find_pii(spark.createDataFrame(rows, "doc_id long, text string"))
    assert no_python(got)
    found = {r.doc_id: r for r in got.collect()}
    for d, t in rows:
        want = brute_pii(t)
        assert found[d].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), (d, want, found[d].spans)
        assert found[d].spans.startswith(want)


def test_contexts_discover_unseen_values(spark):
    cards = ["4111111111111111", "5500005555555559", "4012888888881881", "4222222222222220"[:-1] + "0"]
    cards = [c for c in cards if luhn(c)] + [c for c in ("6011111111111117", "3530111333300000", "5105105105105100", "4000056655665556") if luhn(c)]
    rows = [(i, f"please charge card number {c} today") for i, c in enumerate(cards)] + [(100, "please charge card number 77-1234-99 today"), (101, "built in 20240101 by nobody")]
    got = {r.doc_id: r for r in find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[100].spans == "context:26:36" and got[100].n_context == 1 and got[101].spans == ""


def test_awkward_pii(spark):
    df = awkward(spark)
    assert find_pii(df).count() == df.count() and find_pii(empty(spark)).count() == 0
