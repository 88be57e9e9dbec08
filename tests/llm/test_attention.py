"""The attention model: its gradient, its held-out accuracy, and the rows that every operator must bear."""

import numpy as np
from helpers import awkward, empty
from pyspark.sql import functions as F

from millrace.llm.attention import N_FEATURES, PASSAGE, AttentionModel, encode, fit, quality

LARGER = "/root/testdata/sf0.1"


def test_gradient_is_that_of_the_loss():
    r = np.random.default_rng(5)
    model = AttentionModel.untrained()
    model.weights = tuple(p.astype(float) + 0.1 * r.standard_normal(p.shape) for p in model.weights)
    x, starts, y = r.standard_normal((9, N_FEATURES)), np.array([0, 1, 4]), np.array([1.0, 0.0, 1.0])

    def loss():
        logit = model.forward(x, starts)[0]
        return float(np.mean(np.log1p(np.exp(logit)) - y * logit))

    for p, g in zip(model.weights, model.gradient(starts, y, model.forward(x, starts)), strict=True):
        for _ in range(5):
            at = tuple(r.integers(0, n) for n in p.shape)
            old, h = p[at], 1e-5
            p[at] = old + h
            up = loss()
            p[at] = old - h
            down = loss()
            p[at] = old
            assert abs((up - down) / (2 * h) - g[at]) < 1e-5


def test_attention_finds_the_passage_that_counts():
    """Bags are told apart by one passage among many alike."""
    r = np.random.default_rng(3)
    bags, y = [], np.arange(200) % 2
    for label in y:
        x = 0.3 * r.standard_normal((12, N_FEATURES))
        if label:
            x[r.integers(12), 3] += 4
        bags.append(x)
    model = fit(bags, y.astype(np.float32))
    found = 0
    for x, label in zip(bags, y, strict=True):
        logit, weight, _ = model.forward(model.scaled(x.astype(np.float32)), np.zeros(1, int))
        assert (logit[0] > 0) == label
        found += bool(label) and weight.argmax() == x[:, 3].argmax()
    assert found >= 95


def test_encoding_covers_whole_texts():
    text = " ".join(["word"] * (3 * PASSAGE)) + " !!! ###"
    x = encode(text)
    assert x.shape == (4, N_FEATURES) and not np.allclose(x[3], x[2])
    assert encode("").shape == encode(" \n\t").shape == (1, N_FEATURES) and not encode("").any()
    assert np.array_equal(encode("  padded text \n"), encode("padded text"))


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    got = quality(docs, labels).join(labels, "doc_id").where("held_out").groupBy("quality").agg(F.count("*").alias("n"), F.sum("predicted").alias("kept")).collect()
    by = {r.quality: r for r in got}
    assert by[1].kept >= 0.98 * by[1].n and by[0].kept <= 0.1 * by[0].n


def test_awkward_rows(spark):
    df = awkward(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (6, None), (None, 0), (7, 0), (8, 0)], "doc_id long, quality int")
    got = quality(df, labels).collect()
    assert len(got) == df.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1  # equal texts score alike
    assert len({r.score for r in got if r.doc_id in (3, 4, 5)}) == 1  # no words
    again = quality(df, labels).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert all(abs(sum(p.weight for p in r.passages) - 1) < 1e-3 for r in got)
    plain = quality(df, labels.where("quality = 1")).collect()
    assert len({r.score for r in plain}) == 1
    assert quality(empty(spark), labels).count() == 0
