"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages; only the document has a label.

1. *Encoding.* The whole text is cut into passages of ``PASSAGE`` words. Each becomes a vector: shares
   of kinds of characters and words, repetition inside the passage and in the document, and a
   signed hash of its words and of their endings.
2. *Attention.* A passage's hidden vector h = tanh(Wx) gets the weight softmax(w . (tanh(Vh) * sigmoid(Uh)))
   among the document's passages: the gate lets it ignore what the tangent alone can't.
3. *Score.* The weighted sum of the hidden vectors goes through a logistic unit.

All parameters are fitted together, by Adam on the log loss of document labels, on a bounded sample
of labelled documents. Scoring is one pass over the texts with the model in the tasks; no rows move.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import two_columns, written
from .shingles import _BYTE, _SPACE, _tables, mix

#: Labelled documents that the model is fitted on at most (those with the smallest id hashes), and the
#: passages of each that it sees while it is fitted, spread evenly over the text.
MAX_LABELLED, FIT_PASSAGES = 4_000, 48
#: Words of a passage.
PASSAGE = 64
#: Buckets of the hashed words; sizes of the hidden vector and of the attention.
BUCKETS, HIDDEN, GATE = 64, 24, 12
STEPS, RATE, DECAY = 200, 0.02, 1e-4

#: Classes of bytes: lower-case letters and the first byte of any other letter, upper case, digits, and marks of four kinds.
_CLASSES = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:?", "!", "#$%&*+/<=>@[]^_`{|}~\\", "\"'()-")
_CLASS = np.zeros(256, np.uint8)
for _i, _marks in enumerate(_CLASSES, 1):
    _CLASS[list(_marks.encode())] = _i
_CLASS[0xC0:] = 1
N_SURFACE = 16
N_FEATURES = N_SURFACE + BUCKETS


def _signed(hashes: np.ndarray, passage: np.ndarray, n: int) -> np.ndarray:
    """Hashes added up by bucket, with a sign of their own, for each passage."""
    sign = np.where(hashes & np.uint64(1), 1.0, -1.0)
    bucket = (hashes >> np.uint64(1)).astype(np.int64) % BUCKETS
    return np.bincount(passage * BUCKETS + bucket, sign, minlength=n * BUCKETS).reshape(n, BUCKETS)


def encode(text: str) -> np.ndarray:
    """A vector per passage of a text; a text without words is one passage of zeros."""
    raw = text.encode() + b" "
    buf = np.frombuffer(raw, np.uint8)
    space = _SPACE[buf]
    turn = np.flatnonzero(space[1:] != space[:-1]) + 1
    bounds = turn if space[0] else np.append(0, turn)
    begin, end = bounds[0::2], bounds[1::2]
    begin = begin[: len(end)]
    n_words = len(end)
    if not n_words:
        return np.zeros((1, N_FEATURES), np.float32)
    starts = np.arange(0, n_words, PASSAGE)
    n, sizes = len(starts), np.diff(starts, append=n_words)
    passage = np.repeat(np.arange(n), sizes)
    sizes = sizes.astype(float)
    kind = _CLASS[buf]
    at_byte = np.repeat(np.arange(n), np.diff(np.append(begin[starts], len(buf)), prepend=0)[1:])
    counts = np.bincount(at_byte * 8 + kind[begin[0] :], minlength=n * 8).reshape(n, 8).astype(float)
    letters = counts[:, 1] + counts[:, 2]
    chars = np.maximum(counts[:, 1:].sum(1), 1)
    # words by their hashes: a polynomial over the bytes in lower case, from sums up to each byte
    up, down = _tables(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[np.frombuffer(raw.lower(), np.uint8)] * up[: len(buf)], out=sums[1:])
    words = mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
    endings = mix(_BYTE[buf[end - 1]] * np.uint64(31) + _BYTE[buf[np.maximum(end - 2, begin)]])
    in_word = np.cumsum((kind == 1) | (kind == 2), dtype=np.int32)
    letterless = in_word[end - 1] == np.where(begin > 0, in_word[begin - 1], 0)
    out = np.zeros((n, N_FEATURES), np.float32)
    out[:, 0] = 1
    out[:, 1] = letters / chars
    out[:, 2] = counts[:, 2] / np.maximum(letters, 1)
    out[:, 3:8] = counts[:, 3:8] / chars[:, None]
    out[:, 8] = np.log1p(chars / sizes) / 3
    last = kind[end - 1]
    out[:, 9] = np.bincount(passage, (last > 2).astype(float), minlength=n) / sizes
    out[:, 10] = np.bincount(passage, letterless.astype(float), minlength=n) / sizes
    out[:, 11] = np.log1p(n_words) / 8
    # repetition: distinct words of the passage, pairs of words that stood before in the text, a word after itself
    kinds, number = np.unique(words, return_inverse=True)
    out[:, 12] = np.bincount(np.unique(passage * len(kinds) + number) // len(kinds), minlength=n) / sizes
    _, first = np.unique(number[:-1] * len(kinds) + number[1:], return_index=True)
    repeated = np.ones(n_words)
    repeated[first] = 0
    repeated[-1] = 0
    out[:, 13] = np.bincount(passage, repeated, minlength=n) / sizes
    out[:, 14] = np.bincount(passage, np.append(number[1:] == number[:-1], False).astype(float), minlength=n) / sizes
    out[:, 15] = sizes / PASSAGE
    out[:, N_SURFACE:] = (_signed(words, passage, n) / 2 + _signed(endings, passage, n) / 3) / np.sqrt(sizes)[:, None]
    return out


@dataclass
class AttentionModel:
    mean: np.ndarray
    spread: np.ndarray
    #: W and its bias, V, U, w, c and its bias.
    weights: tuple[np.ndarray, ...]

    @classmethod
    def untrained(cls, seed: int = 1) -> AttentionModel:
        r = np.random.default_rng(seed)
        shape = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        weights = (shape(N_FEATURES, HIDDEN), np.zeros(HIDDEN, np.float32), shape(HIDDEN, GATE), shape(HIDDEN, GATE), shape(GATE), np.zeros(HIDDEN, np.float32), np.zeros(1, np.float32))
        return cls(np.zeros(N_FEATURES, np.float32), np.ones(N_FEATURES, np.float32), weights)

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.spread

    def forward(self, x: np.ndarray, starts: np.ndarray) -> tuple:
        """Log-odds per document and attention per passage of scaled vectors, documents from ``starts`` on; and what the gradient needs."""
        w, bias, v, u, gate, c, offset = self.weights
        sizes = np.diff(starts, append=len(x))
        h = np.tanh(x @ w + bias)
        t, s = np.tanh(h @ v), 1 / (1 + np.exp(-(h @ u)))
        e = (t * s) @ gate
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        a = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(h * a[:, None], starts)
        return z @ c + offset[0], a, (x, h, t, s, z, sizes)

    def gradient(self, starts: np.ndarray, y: np.ndarray, out: tuple) -> list[np.ndarray]:
        """Of the mean log loss, for each of the weights."""
        w, bias, v, u, gate, c, offset = self.weights
        logit, a, (x, h, t, s, z, sizes) = out
        d = ((1 / (1 + np.exp(-logit)) - y) / len(y)).astype(np.float32)
        dz = np.repeat(d, sizes)[:, None] * c
        da = (dz * h).sum(1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, starts), sizes))
        dts = de[:, None] * gate
        dt, ds = dts * s * (1 - t * t), dts * t * s * (1 - s)
        dh = (dz * a[:, None] + dt @ v.T + ds @ u.T) * (1 - h * h)
        return [x.T @ dh, dh.sum(0), h.T @ dt, h.T @ ds, (t * s).T @ de, z.T @ d, d.sum(keepdims=True)]


def fit(bags: list[np.ndarray], y: np.ndarray, steps: int = STEPS, rate: float = RATE, decay: float = DECAY) -> AttentionModel:
    """The model of bags of passage vectors and their labels, in the order given. Without both labels
    it stays untrained, with the labels' share as its score."""
    model = AttentionModel.untrained()
    share = (float(y.sum()) + 1) / (len(y) + 2)
    model.weights[-1][0] = np.log(share / (1 - share))
    if not len(y) or y.min() == y.max():
        return model
    x = np.concatenate(bags).astype(np.float32)
    starts = np.cumsum([0, *(len(b) for b in bags[:-1])])
    model.mean, model.spread = x.mean(0), x.std(0) + np.float32(0.05)
    x = model.scaled(x)
    first, second = ([np.zeros_like(p) for p in model.weights] for _ in range(2))
    for step in range(1, steps + 1):
        grads = model.gradient(starts, y, model.forward(x, starts))
        for p, g, m, s in zip(model.weights, grads, first, second, strict=True):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p -= rate * (m / (1 - 0.9**step) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8) + decay * p)
    return model


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The passages of labelled texts that a model is fitted on."""
    for batch in batches:
        bags = []
        for text in batch.column("text"):
            x = encode(text.as_py())
            bags.append(x[np.unique(np.linspace(0, len(x) - 1, FIT_PASSAGES).astype(int))].ravel())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(bags, pa.list_(pa.float32()))], ["doc_id", "label", "x"])


def _score(model: AttentionModel):
    span = pa.list_(pa.struct([("first_word", pa.int64()), ("weight", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, attention = [], []
            for text in batch.column("text"):
                logit, weight, _ = model.forward(model.scaled(encode(text.as_py())), np.zeros(1, np.int64))
                scores.append(float(1 / (1 + np.exp(-float(logit[0])))))
                attention.append([{"first_word": i * PASSAGE, "weight": round(float(w), 6)} for i, w in enumerate(weight)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(attention, span)], ["doc_id", "score", "passages"])

    return run, "doc_id long, score double, passages array<struct<first_word:long,weight:double>>"


def held_out(col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(col).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> AttentionModel:
    """A model of the labelled documents that are not held out, ``max_labelled`` at most.

    Several labels of an id: the largest counts; a null one is none. Of rows that repeat an id, the one with
    the smallest text is learned from, so the sample is bounded whatever repeats.
    """
    docs = two_columns(docs, id_col, text_col)
    labels = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("doc_id is not null and label is not null")
    chosen = labels.where(~held_out()).groupBy("doc_id").agg(F.max("label").alias("label"))
    # max_labelled rows of two numbers
    chosen = F.broadcast(written(chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)))
    sample = docs.join(chosen, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = sample.mapInArrow(_vectors, "doc_id long, label int, x array<float>").toPandas()  # bounded by max_labelled and FIT_PASSAGES
    rows = rows.sort_values("doc_id")
    return fit([np.asarray(x, np.float32).reshape(-1, N_FEATURES) for x in rows.x], (rows.label.to_numpy() == 1).astype(np.float32))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.3, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted (1 if
    score >= ``threshold``) and passages, the first word of each and its attention weight.

    Rows whose crc32 of the id's text is divisible by 5 are never learned from. Only the text enters
    a score: equal texts score alike. A null text is empty; an empty one is a single passage without
    words. A null id is scored, but never labelled and not held out; rows that repeat an id get a
    row each. Without labels of both kinds all scores are alike. An empty table gives an
    empty result.
    """
    run, schema = _score(train(docs, labels, id_col, text_col, label_col, max_labelled))
    scored = two_columns(docs, id_col, text_col).mapInArrow(run, schema)
    return scored.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"), "passages")
