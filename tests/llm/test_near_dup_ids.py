"""Repeated ids, and band keys that many sets share."""

import random

from test_near_dup import brute, result, shingles

from millrace.llm import near_dup
from millrace.llm.near_dup import near_duplicates


def words(name, n=100, edits=()):
    return " ".join(f"{name}e{i}" if i in edits else f"{name}w{i}" for i in range(n))


def test_an_id_ties_all_its_texts(spark):
    x, y = words("x"), words("y")
    rows = [(1, x), (1, y), (5, words("x", edits=[50])), (6, words("y", edits=[50])), (9, words("z"))]
    a, b = shingles(rows[0][1]), shingles(rows[2][1])
    assert len(a & b) / len(a | b) > 0.85
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(1, 1, True), (5, 1, False), (6, 1, False), (9, 9, True)} and len(got) == 5
    later = [(7, x), (8, y), (8, x), (5, words("y", edits=[50]))]  # the tie is no set's smallest id
    got = near_duplicates(spark.createDataFrame(later, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {5}


def test_strays_under_a_common_key(spark, monkeypatch):
    """Many blocks a key: near copies of one text, and members that other links reach."""
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    rng = random.Random(3)
    rows = [(i, words("b", 60, rng.sample(range(60), rng.choice([0, 0, 1, 1, 2, 3])))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(near_duplicates(df)) == brute(rows)
