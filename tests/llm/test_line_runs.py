"""Repeated runs of lines are deleted to their last line."""

import random

import pytest
from helpers import SF, WORD, documents

from millrace.llm.line_dedup import dedup_lines
from millrace.llm.queries import op3_line_dedup


def brute_runs(rows, min_words=10):
    """All runs of lines with words, of any length, against all earlier positions."""
    first, runs, gone = {}, [], {}
    for d, t in sorted(rows):
        lines = t.split("\n")
        worded = [(i, n) for i, n in ((i, len(WORD.findall(x))) for i, x in enumerate(lines)) if n]
        gone[d] = set()
        for a in range(len(worded)):
            n = 0
            for b in range(a, len(worded)):
                n += worded[b][1]
                if n >= min_words:
                    content, begin, last = tuple(lines[i] for i, _ in worded[a : b + 1]), worded[a][0], worded[b][0]
                    first.setdefault(content, (d, begin, last))
                    runs.append((content, d, begin, last))
    for content, d, begin, last in runs:
        fd, fbegin, flast = first[content]
        if (fd, fbegin) < (d, begin):
            gone[d] |= set(range(max(begin, flast + 1) if fd == d else begin, last + 1))
    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]) for d, t in rows}


def test_short_last_line_of_a_run(spark):
    run = "a b c d e f g h i j k l\nm n o"
    rows = [(1, f"{run}\nfirst goes on"), (2, f"{run}\nsecond goes on"), (3, "one\na b c d e f g h i j k l\nother")]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), whole_runs=True)
    assert {r.doc_id: (r.text, r.n_deleted) for r in got.collect()} == {1: (rows[0][1], 0), 2: ("second goes on", 2), 3: ("one\nother", 1)}


@pytest.mark.parametrize("seed", range(3))
def test_runs_at_random(spark, seed):
    rng = random.Random(seed)
    pool = [" ".join(f"p{i}w{j}" for j in range(rng.choice([0, 1, 3, 5, 12, 60]))) for i in range(12)]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(0, 14)))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.text for r in dedup_lines(df, whole_runs=True).collect()} == brute_runs(rows)


def test_runs_of_the_tables(spark):
    assert {r.doc_id: r.text for r in op3_line_dedup(spark, SF).collect()} == brute_runs([(r.doc_id, r.text) for r in documents(spark).collect()])
