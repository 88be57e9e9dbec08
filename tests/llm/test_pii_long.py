"""Texts with very many entities, and extraction over several rounds, against plain versions."""

import hashlib
import math
import random
import time

from test_native_ops import brute_pii

from millrace.llm.pii import MIN_CONTEXT, MIN_VALUES, discovered, find_pii


def test_many_entities_in_a_long_text(spark):
    text = " ".join(f"mail user{i}@host{i % 9}.com ref id {10**7 + i * 37}" for i in range(8000)) + " 10.0.0.1 +49 30 1234567 4111 1111 1111 1111"
    small = " ".join(text.split(" ")[:300])
    find_pii(spark.createDataFrame([(1, small)], "doc_id long, text string")).collect()  # compile
    began = time.time()
    row = find_pii(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert time.time() - began < 60 and len(text) > 300_000
    assert row.base_sha256 == hashlib.sha256(brute_pii(text).encode()).hexdigest() and row.n_email == 8000


def plain_rounds(edges):
    degree, seeds, values = {}, set(), set()
    for c, v, s in edges:
        degree[c] = degree.get(c, 0) + 1
        values.add(v)
        if s:
            seeds.add(v)
    score = {v: 1.0 for v in seeds}
    for _ in range(200):
        conf = {}
        for c, v, _ in edges:
            conf[c] = conf.get(c, 0.0) + score.get(v, 0.0)
        conf = {c: x / (degree[c] + 1) for c, x in conf.items() if degree[c] >= MIN_VALUES and x / (degree[c] + 1) >= MIN_CONTEXT}
        new = {v: 1.0 for v in seeds}
        for c, v, _ in edges:
            if v not in seeds and c in conf:
                new[v] = new.get(v, 0.0) + math.log(1 - conf[c])
        new = {v: x if v in seeds else 1 - math.exp(x) for v, x in new.items()}
        if new == score:
            break
        score = new
    return {v for v in score if v not in seeds and score[v] >= MIN_CONTEXT}


def test_rounds_until_nothing_rises(spark):
    """A chain: the values found in one context are the evidence for the next."""
    edges = [("c0", f"s{i}", True) for i in range(12)]
    for k in range(6):
        edges += [(f"c{k}", f"v{k}_{i}", False) for i in range(3)] + [(f"c{k + 1}", f"v{k}_{i}", False) for i in range(3)]
        edges += [(f"c{k + 1}", f"t{k}_{i}", True) for i in range(11)]
    rng = random.Random(4)
    edges += list({(f"r{rng.randrange(20)}", f"w{rng.randrange(60)}", False) for _ in range(200)})
    got = {r.value for r in discovered(spark.createDataFrame(edges, "context string, value string, seed boolean")).collect()}
    assert got == plain_rounds(edges) and len(got) >= 15


def test_spaces_and_reach(spark):
    """Contexts are found however much white space lies between."""
    gap = " " * 500 + "\n"
    rows = [(i, f"send{gap}it to{gap}u{i}@example.com{gap}please") for i in range(12)] + [(99, f"send{gap}it to{gap}77-1234-99{gap}please")]
    got = {r.doc_id: r.n_context for r in find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[99] == 1 and sum(got.values()) == 1
