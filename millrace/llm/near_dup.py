"""MinHash near-duplicates with odd sketches.

Plan of the job:

1. One pass over the texts makes, per document, the size and a digest of its shingle
   set, ``BANDS`` band keys of its MinHash samples and two odd sketches: a parity bitmap
   into which the samples are folded, and a wider one into which the whole set is folded.
   Only these few hundred bytes move on.
2. Documents with the same set form a class (an aggregate that combines before the
   shuffle, so thousands of copies cost one row per task); the rest works on classes,
   named by the digest of their set.
3. A sort by ranges of key and class brings the classes of a band key together; keys of
   one class, which are most, go no further. The others are compared with the smallest
   class under their key, which is linear in the number of keys. The odd sketches drop
   pairs that cannot be similar, the full sets confirm the rest, and the confirmed links
   are joined to components.
4. Under each band key only pairs of *different* components are still open. The members
   outside the key's largest component are compared with all members, inside the task,
   sketch against sketch, in blocks of bounded size: one stray member among a million
   costs each of these one comparison and no copy. Only pairs that pass both sketches
   leave the task, to be confirmed on full sets as well.
5. Links between classes become links between the smallest ids of these. An id that has
   several texts ties their classes.

The bits in which two whole-set sketches differ are never more than the shingles in which
the sets differ, so that test loses no link.

No partner is capped: step 4 looks at every pair that steps 2 and 3 left open.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import dealt, joined, two_columns, written
from .shingles import mix, shingle_sets

SAMPLES = 128
#: A pair at 0.85 shares all 6 samples of one band with p = 0.38: 40 bands miss it once in 10^7 or less.
BAND_ROWS, BANDS = 6, 40
#: Below NARROW percent each band has samples of its own: at 0.80 a pair shares those of one band with p = 0.26, and 40 miss it 5 times in 10^6.
NARROW = 85
SKETCH_BITS = 512
#: Parity bitmap of the whole set.
SET_BITS = 4096
#: Pairs whose estimate is below the threshold by more than this are dropped: about 5 standard deviations.
MARGIN = 0.22
#: Most members of a band key that one task compares at once.
BLOCK = 2048

_rng = np.random.default_rng(77)
_MUL = _rng.integers(1, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)
_SUBSETS = np.array([_rng.choice(SAMPLES, BAND_ROWS, replace=False) for _ in range(BANDS)])
_SALT = mix(_rng.integers(0, 1 << 63, SAMPLES, dtype=np.uint64))
_SEPARATE = np.arange(BANDS * BAND_ROWS).reshape(BANDS, BAND_ROWS)
_MUL = np.append(_MUL, _rng.integers(1, 1 << 63, BANDS * BAND_ROWS - SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
_ADD = np.append(_ADD, _rng.integers(0, 1 << 63, BANDS * BAND_ROWS - SAMPLES, dtype=np.uint64))


def minhash(hashes: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """The smallest of the hashes under each of the first multiply-add permutations."""
    least = np.full(samples, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(hashes), 4096):
        least = np.minimum(least, (hashes[i : i + 4096, None] * _MUL[:samples] + _ADD[:samples]).min(axis=0))
    return least


def band_keys(samples: np.ndarray) -> np.ndarray:
    subsets = _SUBSETS if len(samples) == SAMPLES else _SEPARATE
    keys = np.arange(BANDS, dtype=np.uint64)
    for r in range(BAND_ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + samples[subsets[:, r]])
    return keys.view(np.int64)


def odd_sketch(samples: np.ndarray) -> bytes:
    """Each sample flips one bit; samples that two documents share flip the same bit in both."""
    bit = (mix(samples ^ _SALT) % np.uint64(SKETCH_BITS)).astype(np.int64)
    return np.packbits(np.bincount(bit, minlength=SKETCH_BITS) & 1 == 1).tobytes()


def set_sketch(hashes: np.ndarray) -> bytes:
    """The parity bitmap of all hashes."""
    bit = (hashes % np.uint64(SET_BITS)).astype(np.int64)
    return np.packbits(np.bincount(bit, minlength=SET_BITS) & 1 == 1).tobytes()


def most_differing(percent: int) -> int:
    """The largest number of differing bits whose estimate is within MARGIN of the threshold."""
    d = np.arange(SKETCH_BITS + 1)
    return int(d[estimate(d) >= percent / 100 - MARGIN].max())


def estimate(differing: np.ndarray) -> np.ndarray:
    """Similarity from the number of bits in which two sketches differ.

    With d samples in which the documents differ, 2d of SKETCH_BITS bits are flipped at
    random, and a share (1 - exp(-4d/bits))/2 of them ends up set.
    """
    left = np.clip(1 - 2 * differing / SKETCH_BITS, 1e-9, 1)
    return 1 + SKETCH_BITS / (4 * SAMPLES) * np.log(left)


def _signatures(k: int, percent: int):
    samples = SAMPLES if percent >= NARROW else _SEPARATE.size
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.binary()), ("bands", pa.list_(pa.int64())), ("sketch", pa.binary()), ("bitmap", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            texts = batch.column("text")
            for at in range(0, batch.num_rows, 256):
                for s in shingle_sets(texts.slice(at, 256).to_pylist(), k):
                    if len(s):
                        m = minhash(mix(s), samples)
                        rows.append((len(s), _digest(s), band_keys(m), odd_sketch(m[:SAMPLES]), set_sketch(s)))
                    else:
                        rows.append((0, None, None, None, None))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(list(c), t.type) for c, t in zip(cols, list(schema)[1:], strict=True))], schema=schema)

    return run, "doc_id long, n_shingles long, set_id binary, bands array<long>, sketch binary, bitmap binary"


def _digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for at in range(0, batch.num_rows, 64):
                sets = list(shingle_sets(texts.slice(at, 64).to_pylist(), k))
                yield pa.RecordBatch.from_arrays([pa.array([_digest(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["set_id", "shingles"])

    return run, "set_id binary, shingles binary"


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sx"), batch.column("sy"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                if len(x) > len(y):
                    x, y = y, x
                if 100 * len(x) < percent * len(y):
                    keep.append(False)
                    continue
                at = np.searchsorted(y, x)
                common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run, "a long, b long"


def _key_runs():
    """Rows (key, set_id, pivot, end) of partitions sorted by key and set: those of the keys that have
    several sets here, with the smallest of these, and those of a partition's first and last key
    (end), whose other sets may lie in the next partitions. The rows of a key that goes on in
    the next batch wait for it."""

    def several(rows: pa.Table, first: bool, last: bool) -> Iterator[pa.RecordBatch]:
        starts = np.append(0, np.flatnonzero(np.diff(rows.column("key").to_numpy())) + 1)
        n = np.diff(np.append(starts, rows.num_rows))
        end = np.zeros(len(starts), dtype=bool)
        end[0] |= first
        end[-1] |= last
        keep = pa.array(np.repeat((n > 1) | end, n))
        pivot = rows.column("set_id").take(pa.array(np.repeat(starts, n)))
        out = rows.append_column("pivot", pivot).append_column("end", pa.array(np.repeat(end, n))).filter(keep)
        yield from out.to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        first = True
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("key").to_numpy()
            at = int(np.searchsorted(keys, keys[-1]))
            if at or (held and held[-1].column("key")[-1].as_py() != keys[0]):
                yield from several(pa.Table.from_batches([*held, batch.slice(0, at)]), first, False)
                held, first = [], False
            held.append(batch.slice(at))
        if held:
            yield from several(pa.Table.from_batches(held), first, True)

    return run, "key long, set_id binary, pivot binary, end boolean"


def shared_keys(keys: DataFrame) -> DataFrame:
    """(key, set_id, pivot) of the rows (key, set_id), all different, whose key others have too; the pivot
    is the smallest set of the key. The ranges are those of key and set, so that a hot key has many
    partitions; only its rows there and those of two keys a partition are joined."""
    run, schema = _key_runs()
    rows = keys.select("key", "set_id").repartitionByRange("key", "set_id").sortWithinPartitions("key", "set_id").mapInArrow(run, schema)
    rows = written(rows)
    ends = rows.where("end").groupBy("key").agg(F.min("set_id").alias("pivot"), F.count("*").alias("n")).where("n > 1").drop("n")
    return rows.where("not end").drop("end").union(rows.where("end").drop("end", "pivot").join(F.broadcast(ends), "key").select("key", "set_id", "pivot"))


def _close_enough(percent: int):
    """Column: may the pair with these sketches, bitmaps and sizes be as similar as asked?"""
    limit = most_differing(percent)

    @F.pandas_udf("boolean")
    def close(sa: pd.Series, sb: pd.Series, ba: pd.Series, bb: pd.Series, na: pd.Series, nb: pd.Series) -> pd.Series:
        def differing(x: pd.Series, y: pd.Series) -> np.ndarray:
            x, y = (np.frombuffer(b"".join(s), dtype=np.uint64).reshape(len(s), -1) for s in (x, y))
            return np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)

        ok = (differing(sa, sb) <= limit) & (differing(ba, bb) * (100 + percent) <= (na + nb) * (100 - percent))
        return pd.Series(ok & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)))

    return close


def _open_pairs(percent: int):
    """Pairs of different components within each block pair of a band key, by their sketches:
    a member outside the largest component (side 0) with a member of any (side 1). A set is
    named by its digest and its smallest id.

    The rows come sorted by block pair. Most of these have a few rows, so they are cut out of
    the batch as array slices; the last one of a batch waits for the next batch.
    """
    limit = most_differing(percent)

    def matrix(column: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint64).reshape(len(column), -1)

    def group(r: dict[str, np.ndarray], a: int, b: int, out: list[tuple]) -> None:
        rows = np.arange(a, b)
        left, right = rows[r["side"][a:b] == 0], rows[r["side"][a:b] == 1]
        if not len(left) or not len(right):
            return
        sketch, comp, size = r["sketch"][right].T.copy(), r["component"][right], r["size"][right]
        for i in left:
            d = np.bitwise_count(sketch ^ r["sketch"][i][:, None]).sum(axis=0, dtype=np.uint16)
            at = np.flatnonzero((d <= limit) & (comp != r["component"][i]))
            at = at[100 * np.minimum(size[at], r["size"][i]) >= percent * np.maximum(size[at], r["size"][i])]
            if len(at):
                d = np.bitwise_count(r["bitmap"][right[at]] ^ r["bitmap"][i]).sum(axis=1, dtype=np.int64)
                hit = right[at[d * (100 + percent) <= (size[at] + r["size"][i]) * (100 - percent)]]
                if len(hit):
                    out.append((r["set_id"][i], r["rep"][i], r["set_id"][hit], r["rep"][hit]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def found(out: list[tuple]) -> pa.RecordBatch:
            pairs = {(min(p), max(p)) for x, a, ys, bs in out for p in (((x, a), (y, b)) for y, b in zip(ys, bs, strict=True))}
            return pa.RecordBatch.from_arrays([pa.array([p[i][j] for p in pairs], t) for j, t in ((0, pa.binary()), (1, pa.int64())) for i in (0, 1)], ["x", "y", "a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "x", "y", "side", "set_id", "rep", "component", "size")}
            rows |= {c: matrix(batch.column(c)) for c in ("sketch", "bitmap")}
            if held:
                rows = {c: np.concatenate([held[c], rows[c]]) for c in rows}
            new = np.flatnonzero((np.diff(rows["key"]) != 0) | (np.diff(rows["x"]) != 0) | (np.diff(rows["y"]) != 0)) + 1
            cuts = [0, *new.tolist()]
            out: list[tuple] = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                group(rows, a, b, out)
            held = {c: v[cuts[-1] :] for c, v in rows.items()}
            yield found(out)
        if held:
            out = []
            group(held, 0, len(held["key"]), out)
            yield found(out)

    return run, "x binary, y binary, a long, b long"


def _links(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b) of a table (x, y, a, b) of pairs of sets and their smallest ids: those whose full sets
    are similar enough. The pairs of a set that has very many meet copies of it."""
    wanted = pairs.select(F.col("x").alias("set_id"), F.col("a").alias("doc_id")).union(pairs.select("y", "b")).distinct()
    run, schema = _sets(k)
    sets = docs.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi").mapInArrow(run, schema).join(wanted.select("set_id"), "set_id", "left_semi")
    sets = written(sets.groupBy("set_id").agg(F.any_value("shingles").alias("shingles")))
    run, schema = _confirm(percent)
    rows = dealt(pairs, sets.select(F.col("set_id").alias("y"), F.col("shingles").alias("sy")), "y", "x", pairs)
    rows = dealt(rows, sets.select(F.col("set_id").alias("x"), F.col("shingles").alias("sx")), "x", "y", pairs)
    return rows.select("a", "b", "sx", "sy").mapInArrow(run, schema)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Words are runs of non-white-space, A-Z lower-cased; a document's set holds its distinct
    k-word shingles (all its words as one shingle if it has fewer than k). Two documents are
    linked if 100 * |intersection| >= percent * |union|, confirmed on the full sets.
    component_id is the smallest id reachable over links and kept marks that document.

    Null or wordless texts have an empty set and stay alone. Rows that repeat an id count as
    one document that has each of the texts, and is linked by each of them. A row with a null id is linked with nothing,
    has a null component and is kept. An empty table gives an empty result. ``percent`` is 80 to 100: the
    bands would miss links below that.
    """
    if not 80 <= percent <= 100:
        raise ValueError(f"percent is {percent}, not 80 to 100")
    docs = two_columns(docs, id_col, text_col)
    run, schema = _signatures(k, percent)
    sig = written(docs.mapInArrow(run, schema))
    full = sig.where("n_shingles > 0 and doc_id is not null")
    classes = written(full.groupBy("set_id").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")))
    # one row per set: a row of its smallest id; joined on both, so that copies spread
    first = classes.select("set_id", F.col("rep").alias("doc_id"))
    reps = full.join(first, ["set_id", "doc_id"]).dropDuplicates(["set_id", "doc_id"])
    reps = written(reps.select("set_id", F.col("doc_id").alias("rep"), F.col("n_shingles").alias("size"), "bands", "sketch", "bitmap"))
    sketches = reps.select("set_id", "rep", "size", "sketch", "bitmap")
    id_of = reps.select("set_id", "rep")

    keys = written(shared_keys(reps.select("set_id", F.explode("bands").alias("key"))))
    close = _close_enough(percent)
    asked = written(keys.where("set_id <> pivot").select(F.col("pivot").alias("x"), F.col("set_id").alias("y")).distinct())
    # a set is asked about once for each band at most, a pivot by all sets of its bands
    pairs = asked.join(sketches.toDF("y", "b", "nb", "sb", "bb"), "y")
    pairs = dealt(pairs, sketches.toDF("x", "a", "na", "sa", "ba"), "x", "y", asked).where(close("sa", "sb", "ba", "bb", "na", "nb")).select("x", "y", "a", "b")

    # an id that has several texts ties their sets, by the smallest ids of these
    several = full.groupBy("doc_id").agg(F.min("set_id").alias("lo"), F.max("set_id").alias("hi")).where("lo <> hi").select("doc_id")
    several = full.join(several, "doc_id").select("set_id", "doc_id").distinct().join(id_of, "set_id").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    links = written(_links(written(pairs), docs, k, percent).union(several))
    found = components(links)

    def component_of(rows: DataFrame) -> DataFrame:
        return rows.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))

    tagged = written(keys.drop("pivot").join(component_of(id_of), "set_id"))
    counts = tagged.groupBy("key", "component").agg(F.count("*").alias("m"))
    mixed = counts.groupBy("key").agg(F.max_by("component", F.struct("m", "component")).alias("largest"), F.sum("m").alias("n"), F.max("m").alias("m"), F.count("*").alias("kinds")).where("kinds > 1").drop("kinds")
    rows = joined(tagged, mixed, ["key"]).join(sketches.drop("rep"), "set_id")
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    rows = rows.withColumn("strays", blocks(F.col("n") - F.col("m"))).withColumn("blocks", blocks(F.col("n")))
    own = lambda n: F.pmod(F.xxhash64("set_id"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    data = ["key", "set_id", "rep", "component", "size", "sketch", "bitmap"]
    blocked = rows.where("component <> largest").select(*data, own(F.col("strays")).alias("x"), every(F.col("blocks")).alias("y"), F.lit(0).alias("side"))
    blocked = blocked.union(rows.select(*data, every(F.col("strays")).alias("x"), own(F.col("blocks")).alias("y"), F.lit(1).alias("side")))
    run, schema = _open_pairs(percent)
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # the rows are few, the work on them is not
    more = written(blocked.repartition(tasks, "key", "x", "y").sortWithinPartitions("key", "x", "y").mapInArrow(run, schema).distinct())
    if not more.isEmpty():
        links = links.union(_links(more, docs, k, percent))
        found = components(links)
    of_class = component_of(classes.select("set_id", "rep", "n")).select("set_id", "component", "n")
    named = joined(sig.where("n_shingles > 0 and doc_id is not null").select("doc_id", "n_shingles", "set_id"), of_class, ["set_id"]).select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    alone = sig.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return named.union(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


#: What ``near_duplicates`` returns on the table documents, in DuckDB's SQL: all pairs that share a shingle.
NEAR_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
                             WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS hits FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM c JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * hits >= 85 * (x.n + y.n - hits)),
r AS (
  SELECT doc_id, doc_id AS other FROM d
  UNION
  SELECT r.doc_id, q.b FROM r JOIN (SELECT a, b FROM e UNION ALL SELECT b, a FROM e) AS q ON q.a = r.other)
SELECT r.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.other) AS component_id, min(r.other) = r.doc_id AS kept
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""
