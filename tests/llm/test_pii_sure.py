"""The surest values, whose score rounds to 1.0, are found."""

import string

from millrace.llm.pii import find_pii


def test_value_in_many_confident_contexts(spark):
    phrases = [f"p{a}x q{a}y %s r{a}z" for a in string.ascii_lowercase[:20]]
    seeds = [f"user{i}@example.com" for i in range(12)]
    rows = [(100 * i + j, p % v) for i, p in enumerate(phrases) for j, v in enumerate([*seeds, "77-1234-99"])]
    got = {r.doc_id: r for r in find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in range(len(phrases)):
        assert got[100 * i + 12].spans == "context:8:18"
        assert got[100 * i].n_email == 1 and got[100 * i].n_context == 0
