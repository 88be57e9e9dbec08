"""Toxic passages by maximum-scoring segments of token log-odds.

1. *Lexicon.* Counts of the documents of a bounded labelled sample that hold a word, or words of a
   prefix, give log-odds between the toxic and the other documents under a Dirichlet prior whose
   pseudo-counts follow the pooled frequencies. A word that one document repeats counts once. Features whose log-odds are significant
   get a positive integer score; every other token scores -1.
2. *Tagging.* One pass over all texts keeps, per document, the token count and the
   positions and scores of its lexicon tokens.
3. *Extreme-value statistics.* The score distribution over all tokens of the corpus gives
   lambda and K of the limit law of maximal segment scores.
4. *Segments.* A linear scan finds all maximal scoring segments of a document; each gets a
   normalised score lambda*S - ln(K*n), and those unlikely by chance are reported.
5. *Calibration.* A logistic curve over the aggregated scores of the reported segments, and nothing
   else of a text, turns them into a probability. It is cross-fitted: the scores of a fold of the labelled sample come from a
   lexicon that did not see that fold.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import two_columns, written

#: Labelled rows that the classifier is fitted on at most; the ones with the smallest id hash.
MAX_LABELLED = 20_000
#: Nats of log-odds per score unit; every token outside the lexicon costs one unit.
UNIT = 0.03
PREFIXES = (3, 4, 5, 6, 7, 8)
#: Pseudo-tokens of the Dirichlet prior, as a share of the sample's tokens.
PRIOR = 0.02
MIN_Z, MIN_Z_PREFIX, MIN_ODDS = 2.0, 4.0, 1.5
FOLDS = 3
#: A segment is reported if so many are expected by chance in a document of its length.
EXPECTED = 0.05

_TOKEN = re.compile(r"[^\W\d_]+")


def tokens(text: str) -> list[str]:
    """Runs of letters, lower-cased."""
    return _TOKEN.findall(text.lower())


class Lexicon(dict):
    """Token -> score. A word outside it falls back to its longest prefix inside, then to -1.

    Looked-up words are remembered up to a fixed number, then forgotten.
    """

    remembered = 400_000

    def __init__(self, words: dict[str, int], prefixes: dict[str, int]):
        super().__init__(words)
        self.words, self.prefixes = words, prefixes

    def __missing__(self, word: str) -> int:
        score = -1
        for n in reversed(PREFIXES):
            if len(word) > n and word[:n] in self.prefixes:
                score = self.prefixes[word[:n]]
                break
        if len(self) > self.remembered:
            self.clear()
            self.update(self.words)
        self[word] = score
        return score

    def __reduce__(self):
        return Lexicon, (self.words, self.prefixes)


@dataclass
class ToxicityModel:
    words: dict[str, int] = field(default_factory=dict)
    prefixes: dict[str, int] = field(default_factory=dict)
    #: Intercept and weights of the features of ``_features``.
    weights: tuple[float, ...] = (-3.0, 0.0, 0.0, 0.0)


def maximal_segments(positions: list[int], scores: list[int]) -> list[tuple[int, int, int]]:
    """All maximal scoring segments (start, end exclusive, score), in linear time.

    The sequence has ``scores`` at ``positions`` and -1 everywhere else. Candidates are kept
    with the cumulative sums to their left and right; a new one is merged with the nearest
    earlier candidate of smaller left sum as long as its right sum is larger.
    """
    out: list[list[int]] = []  # start, end, left sum, right sum, index of the candidate to its left with a smaller left sum
    total, at = 0, 0
    for p, s in zip(positions, scores, strict=True):
        total -= p - at
        at = p + 1
        new = [p, p + 1, total, total + s, -1]
        total += s
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= new[2]:
                j = out[j][4]
            new[4] = j
            if j < 0 or out[j][3] >= new[3]:
                out.append(new)
                break
            new = [out[j][0], new[1], out[j][2], new[3], out[j][4]]
            del out[j:]
    return [(a, b, right - left) for a, b, left, right, _ in out]


def _tag(model: ToxicityModel):
    lexicon = Lexicon(model.words, model.prefixes)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("positions", pa.list_(pa.int32())), ("scores", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, positions, scores = [], [], []
            for text in batch.column("text"):
                toks = tokens(text.as_py() or "")
                s = np.fromiter(map(lexicon.__getitem__, toks), np.int32, len(toks))
                hit = np.flatnonzero(s > 0)
                counts.append(len(toks))
                positions.append(hit.astype(np.int32))
                scores.append(s[hit])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(positions, pa.list_(pa.int32())), pa.array(scores, pa.list_(pa.int32()))], schema=schema)

    return run, "doc_id long, n_tokens long, positions array<int>, scores array<int>"


def _statistics(tagged: DataFrame) -> tuple[float, float]:
    """lambda and K from the scores of all tokens. As -1 is the only negative score, K has a closed form."""
    rows = tagged.select(F.explode("scores").alias("s")).groupBy("s").count().collect()  # as many rows as the lexicon has scores
    n = tagged.agg(F.sum("n_tokens")).first()[0] or 0
    hist = {r["s"]: r["count"] for r in rows}
    other = n - sum(hist.values())
    if not hist or other <= 0:
        return 0.1, 0.1
    s = np.array([-1, *hist], dtype=float)
    p = np.array([other, *hist.values()], dtype=float) / n
    if (mean := float((p * s).sum())) >= 0:  # so common that segments are no extremes: rarer by a fixed factor
        p[1:] *= 0.5 * p[0] / float((p[1:] * s[1:]).sum())
        p[0] = 1 - p[1:].sum()
        mean = float((p * s).sum())
    lo, hi = 0.0, 1.0
    while (p * np.exp(hi * s)).sum() < 1:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (p * np.exp(mid * s)).sum() < 1 else (lo, mid)
    lam = (lo + hi) / 2
    k = mean * mean / float((p * s * np.exp(lam * s)).sum()) * (1 - math.exp(-lam))
    return lam, max(k, 1e-12)


def _segments(lam: float, k: float):
    seg = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.int32())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("best", pa.float64()), ("total", pa.float64()), ("covered", pa.float64()), ("passages", pa.list_(seg))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, total, covered, passages = [], [], [], []
            for n, pos, sc in zip(batch.column("n_tokens").to_pylist(), batch.column("positions").to_pylist(), batch.column("scores").to_pylist(), strict=True):
                base = math.log(k * max(n, 1))
                found = [(a, b, s, lam * s - base) for a, b, s in maximal_segments(pos, sc)]
                good = [f for f in found if math.exp(-f[3]) <= EXPECTED]
                best.append(max((f[3] for f in good), default=0.0))
                total.append(sum(f[3] for f in good))
                covered.append(sum(f[1] - f[0] for f in good) / max(n, 1))
                passages.append([{"start": a, "end": b, "score": s} for a, b, s, _ in good])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_tokens"), pa.array(best, pa.float64()), pa.array(total, pa.float64()), pa.array(covered, pa.float64()), pa.array(passages, pa.list_(seg))], schema=schema)

    return run, "doc_id long, n_tokens long, best double, total double, covered double, passages array<struct<start:int,end:int,score:int>>"


def _features(best, total, covered, log1p=F.log1p):
    """The reported passages and nothing else: the normalised score of the best, that of all together
    (the r-segment sum), on a logarithmic scale, and the share of the text that they cover. Without any, all are 0."""
    return [log1p(best), log1p(total), covered]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for text, toxic, fold in zip(batch.column("text"), batch.column("toxic").to_pylist(), batch.column("fold").to_pylist(), strict=True):
            for w in set(tokens(text.as_py() or "")):
                counts[w, toxic, fold] += 1
        rows = [(*key, n) for key, n in counts.items()]
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["word", "toxic", "fold", "n"])


def _lexicon(words: DataFrame) -> ToxicityModel:
    """All significant features from (word, toxic, n) counts of the bounded sample, whose words bound what is collected."""
    cells = words.groupBy("word").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c"))
    sums = cells.agg(F.sum("t"), F.sum("c")).first()
    nt, nc = float(sums[0] or 0), float(sums[1] or 0)
    if not nt or not nc:
        return ToxicityModel()
    prior = PRIOR * (nt + nc)
    pseudo = (F.col("t") + F.col("c")) * F.lit(PRIOR)
    ft, fc = F.col("t") + pseudo, F.col("c") + pseudo
    odds = F.log(ft / F.lit(nt + prior)) - F.log(fc / F.lit(nc + prior))

    def significant(df: DataFrame, z: float) -> DataFrame:
        df = df.withColumn("odds", odds).withColumn("z", F.col("odds") / F.sqrt(1 / ft + 1 / fc))
        return df.where((F.col("z") >= z) & (F.col("t") >= 3) & (F.col("odds") >= MIN_ODDS))

    top = significant(cells, MIN_Z).select("word", "odds").collect()
    unit = lambda x: max(1, round(x / UNIT))
    known = {r["word"]: unit(r["odds"]) for r in top}
    stems = cells.select(F.explode(F.expr("transform(filter(array(%s), k -> length(word) > k), k -> substring(word, 1, k))" % ",".join(map(str, PREFIXES)))).alias("word"), "t", "c")
    stems = stems.groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c"), F.count("*").alias("kinds")).where("kinds >= 3")
    top = significant(stems, MIN_Z_PREFIX).select("word", "odds").collect()
    prefixes = {r["word"]: unit(r["odds"]) for r in top}
    if prefixes:  # words with evidence of their own against them don't fall back to a prefix
        frame = words.sparkSession.createDataFrame([(p,) for p in prefixes], "stem string")
        hard = cells.where((F.col("c") >= 3) & (odds < MIN_ODDS)).select("word", F.explode(F.expr("transform(array(%s), k -> substring(word, 1, k))" % ",".join(map(str, PREFIXES)))).alias("stem"))
        rows = hard.join(F.broadcast(frame), "stem").select("word").distinct().collect()
        known |= {r["word"]: -1 for r in rows if r["word"] not in known}
    return ToxicityModel(known, prefixes)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Newton steps of a ridge logistic regression; the intercept is not shrunk."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    pull = np.eye(x.shape[1]) * ridge
    pull[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pull, x.T @ (y - p) - pull @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(col).cast("string")) % 5 == 0, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.5),
    n_tokens and passages, the significant segments by token position and score.

    ``labels`` has an id and a label column (1 toxic, 0 not; null: no label; several labels of
    an id: the largest counts; of rows that repeat a labelled id, one is learned from). Rows whose crc32 of the id's text is divisible by 5 are never
    learned from. Only the passages enter a score: equal texts score alike, and so do all texts
    without any, empty and null ones too. Without labels of both kinds the
    lexicon is empty and all documents score alike, below 0.5. A null id is scored, but never
    labelled and not held out. An empty table gives an empty result.
    """
    docs = two_columns(docs, id_col, text_col)
    labels = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    train = labels.where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # at most max_labelled rows of two numbers, so the broadcast is bounded by that parameter
    train = F.broadcast(written(train.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)))
    # of rows that repeat an id, the one with the smallest text
    sample = docs.join(train, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)).cast("int"))
    sample = written(sample)
    words = written(sample.select("text", "toxic", "fold").mapInArrow(_count, "word string, toxic int, fold int, n long").groupBy("word", "toxic", "fold").agg(F.sum("n").alias("n")))
    model = _lexicon(words)

    def segments(model: ToxicityModel, docs: DataFrame) -> DataFrame:
        run, schema = _tag(model)
        tagged = written(docs.select("doc_id", "text").mapInArrow(run, schema))
        run, schema = _segments(*_statistics(tagged))
        return tagged.mapInArrow(run, schema)

    apart = [segments(_lexicon(words.where(F.col("fold") != f)), sample.where(F.col("fold") == f)) for f in range(FOLDS)]
    seen = reduce(DataFrame.union, apart)
    fit = seen.join(train, "doc_id").select("best", "total", "covered", "toxic").toPandas()  # at most max_labelled rows of four numbers
    weights = model.weights
    if fit.toxic.nunique() > 1:
        x = np.column_stack(_features(fit.best.to_numpy(), fit.total.to_numpy(), fit.covered.to_numpy(), np.log1p))
        weights = tuple(map(float, _logistic(x, (fit.toxic == 1).to_numpy(float))))
    scored = written(segments(model, docs))
    z = F.lit(weights[0])
    for w, f in zip(weights[1:], _features(F.col("best"), F.col("total"), F.col("covered")), strict=True):
        z = z + F.lit(w) * f
    score = 1 / (1 + F.exp(-z))
    return scored.select("doc_id", held_out().alias("held_out"), score.alias("score"), F.when(score >= 0.5, 1).otherwise(0).alias("predicted"), "n_tokens", "passages")
