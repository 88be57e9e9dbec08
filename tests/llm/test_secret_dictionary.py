"""The dictionary comes from the corpus; planted secrets against guessable values."""

import random
import string
import time

import pytest
from helpers import documents
from pyspark.sql import functions as F

from millrace.llm.secrets import base_spans, find_secrets, identifiers, novel_spans

RANDOM = "q8Zx2Lm9Vt4Rk7Bn1Wp6"


def found(text):
    return [text[a:b] for _, a, b in novel_spans(text, base_spans(text))]


def test_planted_secrets(spark):
    """Half of the values are random, half are made of words that other documents use."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices(string.ascii_lowercase, k=rng.randint(4, 9))) for _ in range(300)]
    prose = [(i, " ".join(rng.choices(vocabulary, k=400))) for i in range(200)]
    forms = ["export AUTH_KEY=%s", 'private_key = "%s"', "signingKey: %s", "db.session.salt = '%s'", "hmac_credential:      %s"]
    planted = []
    for i in range(400):
        if i % 2:
            value = "".join(rng.choices(string.ascii_letters + string.digits, k=rng.randint(20, 40)))
        else:
            value = "_".join(rng.choices(vocabulary, k=4)) + str(rng.randrange(10))
        around = " ".join(rng.choices(vocabulary, k=30)), " ".join(rng.choices(vocabulary, k=30))
        planted.append((1000 + i, f"{around[0]}\n{rng.choice(forms) % value}\n{around[1]}"))
    rows = {r.doc_id: r.n_novel for r in find_secrets(spark.createDataFrame(prose + planted, "doc_id long, text string")).collect()}
    hits = [rows[1000 + i] for i in range(1, 400, 2)]
    wrong = [rows[1000 + i] for i in range(0, 400, 2)]
    assert sum(hits) >= 196 and max(hits) == 1 and sum(wrong) <= 6 and not any(rows[i] for i in range(200))


def test_words_of_one_copied_secret_stay_out(spark):
    docs = [(f"alpha beta gamma key=QwErTyabcdefZxCvBn{i % 3}",) for i in range(500)] + [(f"w{chr(97 + i % 26)}{chr(97 + i // 26)} common word",) for i in range(200)]
    words = identifiers(spark.createDataFrame(docs, "text string")).split()
    assert "common" in words and not any("QwErTy" in w for w in words)
    assert identifiers(documents(spark).select("text")) and identifiers(documents(spark).select(F.lit(None).cast("string").alias("text"))) == ""


@pytest.mark.parametrize("text", ["client_credential =" + " " * 6 + "%s", "client_credential" + "\t" * 300 + "%s", "a" * 200 + "_key = %s", "key: " + "T" * 300 + " = '%s'"])
def test_no_limits_on_blanks_and_names(text):
    assert found(text % RANDOM) == [RANDOM]


def test_long_texts_end():
    began = time.time()
    for t in ("key1A=" * 2000, "a.b-" * 30000, ("my_key = " + RANDOM + "\n") * 3000, "key" + " " * 200000 + "x", ("key" + " " * 50) * 4000):
        found(t)
    assert time.time() - began < 90
