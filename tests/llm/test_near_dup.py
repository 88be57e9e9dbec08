import itertools
import random

import numpy as np
import pytest
from helpers import WORD, awkward, documents, empty

from millrace.llm.components import components
from millrace.llm.near_dup import estimate, minhash, near_duplicates, odd_sketch, set_sketch
from millrace.llm.shingles import mix, shingle_sets


def shingles(text, k=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, percent=85):
    sets, parent = {}, {}
    for d, t in rows:
        sets.setdefault(d, shingles(t))
        parent[d] = d

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            p, q = find(a), find(b)
            parent[max(p, q)] = min(p, q)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_tables_against_brute_force(spark):
    docs = documents(spark)
    assert result(near_duplicates(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_large_group_of_near_copies_with_outliers(spark):
    """Copies of one text with edits: many links, chains, and pairs just below the threshold."""
    rng = random.Random(1)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(260):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(1000)}"
        rows.append((i, " ".join(words)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert 1 < len({c for _, c, _ in want.values()}) < 200
    assert result(near_duplicates(df)) == want


def test_awkward_rows(spark):
    got = near_duplicates(awkward(spark))
    rows = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in got.collect()}
    assert got.count() == 13
    assert rows[2, 4] == (1, False) and rows[10, 4] == (1, False) and rows[1, 4] == (1, True)
    assert rows[3, 0] == (3, True) and rows[5, 0] == (5, True) and rows[6, 1] == (6, True)
    assert [v for k, v in rows.items() if k[0] is None] == [(None, True)] * 2
    assert next(v for k, v in rows.items() if k[0] == 8) == (7, False)
    assert near_duplicates(empty(spark)).count() == 0


def test_sets_are_those_of_the_words():
    texts = ["a b c d e f", "A b\tc d\x0be F", "a b c", "", None, "x " * 3000, "é è ê ë ē ĕ"]
    got = list(shingle_sets(texts))
    assert [len(s) for s in got] == [len(shingles(t)) for t in texts]
    assert (got[0] == got[1]).all()
    assert len({int(x) for t in ("a b", "ab", "a b c", "a", "b a") for x in next(shingle_sets([t]))}) == 5


@pytest.mark.parametrize("share", [0.5, 0.8, 0.9])
def test_sketches_estimate_similarity(share):
    rng = np.random.default_rng(4)
    errors = []
    for _ in range(30):
        both, a, b = (mix(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (round(1000 * share), 500 - round(500 * share), 500 - round(500 * share)))
        x, y = np.concatenate([both, a]), np.concatenate([both, b])
        true = len(both) / (len(both) + len(a) + len(b))
        bits = lambda s, t: np.bitwise_count(np.frombuffer(s, np.uint8) ^ np.frombuffer(t, np.uint8)).sum()
        errors.append(float(estimate(bits(odd_sketch(minhash(x)), odd_sketch(minhash(y))))) - true)
        assert bits(set_sketch(x), set_sketch(y)) <= len(a) + len(b)
    assert abs(np.mean(errors)) < 0.03 and np.abs(errors).max() < 0.22


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150), (7, 7), (3, 900), (900, 3)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, 900: 0, 100: 100, 200: 100, 150: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
