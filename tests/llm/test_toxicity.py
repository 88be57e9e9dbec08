import itertools
import random

import pytest
from helpers import SF, awkward, empty
from pyspark.sql import functions as F

from millrace.llm.toxicity import Lexicon, maximal_segments, tokens, toxicity


def brute_maximal(scores):
    """All maximal scoring subsequences by their definition: the best segment, then the same left and right of it."""
    best = None
    for a, b in itertools.combinations(range(len(scores) + 1), 2):
        s = sum(scores[a:b])
        if s > 0 and (best is None or (s, a - b) > (best[2], best[0] - best[1])):
            best = (a, b, s)
    if best is None:
        return []
    a, b, s = best
    return brute_maximal(scores[:a]) + [best] + [(x + b, y + b, z) for x, y, z in brute_maximal(scores[b:])]


@pytest.mark.parametrize("seed", range(40))
def test_segments_are_the_maximal_ones(seed):
    rng = random.Random(seed)
    scores = [rng.choice([-1, -1, -1, rng.randint(1, 40) / 8]) for _ in range(rng.randint(1, 16))]
    hits = [i for i, s in enumerate(scores) if s > 0]
    got = maximal_segments(hits, [scores[i] for i in hits])
    assert sorted((a, b, round(s, 9)) for a, b, s in got) == sorted((a, b, round(s, 9)) for a, b, s in brute_maximal(scores))


def test_lexicon_falls_back_to_prefixes():
    lexicon = Lexicon({"bad": 9, "stemword": -1}, {"stem": 4, "stemx": 6})
    assert [lexicon[w] for w in ("bad", "stemword", "stemmy", "stemxy", "stem", "other")] == [9, -1, 4, 6, -1, -1]


def labelled(spark, n=400):
    rng = random.Random(3)
    plain = [f"word{i}" for i in range(60)]
    rows = []
    for i in range(n):
        words = rng.choices(plain, k=40)
        if i % 4 == 0:
            for _ in range(3):
                words[rng.randrange(40)] = rng.choice(["vile", "rotten", "scoundrel"])
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (5, None)], "doc_id long, toxic int")
    return docs, labels, {r[0]: r[2] for r in rows}


def test_held_out_accuracy_and_passages(spark):
    docs, labels, truth = labelled(spark)
    got = toxicity(docs, labels).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 400 and 50 < len(held) < 110
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95
    assert all((r.score >= 0.5) == (r.predicted == 1) and 0 <= r.score <= 1 for r in got)
    assert all(r.passages for r in held if r.predicted)


def test_labels_of_held_out_rows_do_not_matter(spark):
    import zlib

    docs, labels, truth = labelled(spark)
    flipped = spark.createDataFrame([(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in truth.items()], "doc_id long, toxic int")
    a = {r.doc_id: r.score for r in toxicity(docs, labels).collect()}
    assert a == {r.doc_id: r.score for r in toxicity(docs, flipped).collect()}


def test_awkward_rows(spark):
    _, labels, _ = labelled(spark)
    rows = toxicity(awkward(spark), labels).collect()
    assert len(rows) == awkward(spark).count() and all(r.score is not None for r in rows)
    assert len({r.score for r in rows if r.n_tokens == 0}) == 1
    assert toxicity(empty(spark), labels).count() == 0
    none = toxicity(awkward(spark), labels.where("false")).collect()
    assert {r.predicted for r in none} == {0}


def test_on_the_tables(spark):
    got = toxicity(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    assert got.count() == 200 and got.where("held_out").count() > 20


def test_score_is_a_function_of_the_passages(spark):
    """Documents with the same passages and length score alike, whatever else stands in them; those without any all do."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    scored = toxicity(docs, labels)
    found = scored.where("size(passages) > 0").groupBy("n_tokens", F.to_json("passages")).agg(F.countDistinct("score").alias("k"))
    assert found.where("k > 1").count() == 0
    assert scored.where("size(passages) = 0").select("score").distinct().count() == 1
    # a text that swaps every token outside its passages for filler keeps its score
    best = scored.where("size(passages) > 0").orderBy(F.desc("score"), "doc_id").limit(3).collect()
    texts = {r.doc_id: r.text for r in docs.join(spark.createDataFrame([(r.doc_id,) for r in best], "doc_id long"), "doc_id").collect()}
    swapped = []
    for r in best:
        inside = {i for p in r.passages for i in range(p.start, p.end)}
        swapped.append((10**9 + r.doc_id, " ".join(t if i in inside else "zq" for i, t in enumerate(tokens(texts[r.doc_id])))))
    again = toxicity(docs.select("doc_id", "text").union(spark.createDataFrame(swapped, "doc_id long, text string")), labels)
    got = {r.doc_id: r for r in again.collect()}
    for r in best:
        a, b = got[r.doc_id], got[10**9 + r.doc_id]
        assert a.passages == b.passages and a.score == b.score
