"""Band keys that several sets have: found without a join of all keys."""

import random
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import near_dup
from millrace.llm.near_dup import near_duplicates, shared_keys


def test_joins_get_only_shared_keys(spark, monkeypatch):
    """Before, all 40 keys of each set went through the anti-join that takes out hot keys."""
    given = []

    def joined(rows, keyed, on, real=near_dup.joined):
        if on == ["key"]:
            given.append(rows.count())
        return real(rows, keyed, on)

    monkeypatch.setattr(near_dup, "joined", joined)
    texts = [" ".join(f"own{i}x{j}" for j in range(40)) for i in range(300)]
    texts += [" ".join([f"w{j}" for j in range(200)] + [f"end{i}"]) for i in range(6)]
    got = near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id for r in got if not r.kept} == {301, 302, 303, 304, 305} and len(got) == 306
    assert sum(given) <= 40 * 6 < 40 * 306


def expected(rows):
    sets = defaultdict(set)
    for k, s in rows:
        sets[k].add(s)
    return sorted((k, s, min(sets[k])) for k, s in rows if len(sets[k]) > 1)


@pytest.mark.parametrize("partitions, batch", [(1, 10_000), (16, 10_000), (16, 7), (300, 3)])
def test_shared_keys_against_brute_force(spark, partitions, batch):
    """A third of the rows have one key, the others keys of 1 to 4 sets."""
    rng = random.Random(partitions + batch)
    rows = [(77, rng.randbytes(16)) for _ in range(700)]
    rows += [(rng.choice([-1, 1]) * rng.getrandbits(62) if n == 1 else k, rng.randbytes(16)) for k in range(-300, 300) for n in [rng.choice([1, 1, 2, 3, 4])] for _ in range(n)]
    rng.shuffle(rows)
    conf = {"spark.sql.shuffle.partitions": partitions, "spark.sql.execution.arrow.maxRecordsPerBatch": batch, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = shared_keys(spark.createDataFrame(rows, "key long, set_id binary")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted((r.key, bytes(r.set_id), bytes(r.pivot)) for r in got) == expected(rows)


def test_no_shared_keys(spark):
    one = spark.createDataFrame([(1, b"a"), (2, b"a"), (3, b"b")], "key long, set_id binary")
    assert shared_keys(one).count() == 0 and shared_keys(one.where(F.lit(False))).count() == 0


@pytest.mark.parametrize("keys", ["aabbb", "abc", "aaaa", "a", "abbc", "aabcc", "abbbbc"])
def test_runs_do_not_depend_on_batches(keys):
    run, _ = near_dup._key_runs()
    rows = pa.RecordBatch.from_arrays([pa.array([ord(k) for k in keys], pa.int64()), pa.array([bytes([i]) for i in range(len(keys))])], ["key", "set_id"])
    want = [(ord(k), bytes([i]), bytes([keys.index(k)]), k in keys[0] + keys[-1]) for i, k in enumerate(keys) if keys.count(k) > 1 or k in keys[0] + keys[-1]]
    for cut in range(2 ** (len(keys) - 1)):
        at = [0, *(i for i in range(1, len(keys)) if cut >> (i - 1) & 1), len(keys)]
        batches = [b for x, y in zip(at, at[1:]) for b in (rows.slice(x, 0), rows.slice(x, y - x))]
        assert [tuple(r.values()) for b in run(iter(batches)) for r in b.to_pylist()] == want
