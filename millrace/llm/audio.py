"""Chroma audio fingerprints and the alignment of recordings.

One pass over the media column decodes each recording, folds its spectrum into twelve pitch
classes per frame and runs a bank of rectangle filters over the frames. A filter compares
sums of rectangles, which an integral image gives in four look-ups; its value is quantised
to two bits, and sixteen filters make one packed integer per frame.

To align clips with recordings, equal fingerprints form a class on either side, and classes
are compared. Landmarks (the more robust bits of three frames) that a clip and a recording
share vote for the offset between them; the offset with most votes is checked by the share
of bits in which the aligned fingerprints differ.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import dealt, joined, written

RATE = 8_000
FRAME, HOP = 1024, 128
LOWEST_HZ, HIGHEST_HZ = 100.0, 2_000.0
#: Half width of the middle band of the quantiser, in log ratio.
BAND = 0.15
#: Frames between the integers of a landmark; the bits of these that say which of two rectangles is larger.
GAP, SIGNS = 8, 0xAAAAAAAA - (1 << 32)
#: Aligned frames at least, and the share of differing bits at most, of a match.
MIN_FRAMES, MAX_ERROR = 96, 0.2


@cache
def _bank() -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int, int]]]:
    hz = np.fft.rfftfreq(FRAME, 1 / RATE)
    fold = np.zeros((len(hz), 12), dtype=np.float32)
    heard = np.flatnonzero((hz >= LOWEST_HZ) & (hz <= HIGHEST_HZ))
    fold[heard, np.round(12 * np.log2(hz[heard] / 440)).astype(int) % 12] = 1
    # kind of split, first pitch class, pitch classes, frames
    filters = [(i % 5, (5 * i) % (13 - h), h, w) for i, (h, w) in enumerate((h, w) for w in (6, 12, 18, 24) for h in (3, 6, 9, 12))]
    return fold, np.hanning(FRAME).astype(np.float32), filters


def chroma(samples: np.ndarray) -> np.ndarray:
    """frames x 12, smoothed over five frames, each of length 1 (or 0 where it is silent)."""
    fold, window, _ = _bank()
    if len(samples) < FRAME:
        return np.zeros((0, 12), dtype=np.float64)
    frames = np.lib.stride_tricks.sliding_window_view(samples.astype(np.float32), FRAME)[::HOP]
    out = np.concatenate([np.abs(np.fft.rfft(frames[i : i + 512] * window, axis=1)) ** 2 @ fold for i in range(0, len(frames), 512)])
    pad = np.pad(out, ((2, 2), (0, 0)))
    out = sum(w * pad[i : i + len(out)] for i, w in enumerate((0.25, 0.75, 1.0, 0.75, 0.25)))
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return np.where(norm > 1e-3, out / np.maximum(norm, 1e-3), 0.0)


def packed(features: np.ndarray) -> np.ndarray:
    """One int32 per frame at which the widest filter fits."""
    _, _, filters = _bank()
    n = len(features) - max(w for *_, w in filters) + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int32)
    image = np.pad(features.cumsum(axis=0).cumsum(axis=1), ((1, 0), (1, 0)))
    at = np.arange(n)

    def area(t0: int, t1: int, y0: int, y1: int) -> np.ndarray:
        return image[at + t1, y1] - image[at + t0, y1] - image[at + t1, y0] + image[at + t0, y0]

    out = np.zeros(n, dtype=np.uint32)
    for i, (kind, y, h, w) in enumerate(filters):
        whole, mid_t, mid_y = area(0, w, y, y + h), w // 2, y + h // 2
        size = h * w
        if kind == 0:  # later against earlier
            a, part = area(mid_t, w, y, y + h), h * (w - mid_t)
        elif kind == 1:  # upper pitch classes against lower
            a, part = area(0, w, mid_y, y + h), w * (y + h - mid_y)
        elif kind == 2:  # one diagonal against the other
            a, part = area(0, mid_t, y, mid_y) + area(mid_t, w, mid_y, y + h), mid_t * (mid_y - y) + (w - mid_t) * (y + h - mid_y)
        elif kind == 3:  # the middle in time against what is around it
            a, part = area(w // 4, w - w // 4, y, y + h), (w - 2 * (w // 4)) * h
        else:  # the middle in pitch
            a, part = area(0, w, y + h // 3, y + h - h // 3), w * (h - 2 * (h // 3))
        value = np.log((1e-2 + a / part) / (1e-2 + (whole - a) / (size - part)))
        level = np.digitize(value, (-BAND, 0.0, BAND))
        out |= ((level ^ (level >> 1)).astype(np.uint32) & np.uint32(3)) << np.uint32(2 * i)
    return out.view(np.int32)


def fingerprints(media: DataFrame, decode: Callable[[object], np.ndarray], id_col: str = "id", media_col: str = "media") -> DataFrame:
    """(id, fingerprint array<int>) of every recording; ``decode`` turns a value of the media
    column into mono samples at RATE. Null, empty and too short recordings have no integers."""
    schema = pa.schema([("id", pa.int64()), ("fingerprint", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                out = []
                for value in part.column("media"):
                    value = value.as_py()
                    out.append(np.zeros(0, np.int32) if value is None or not len(value) else packed(chroma(decode(value))))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(out, pa.list_(pa.int32()))], schema=schema)

    return media.select(F.col(id_col).cast("long").alias("id"), F.col(media_col).alias("media")).mapInArrow(run, "id long, fingerprint array<int>")


def _landmarks(classes: DataFrame) -> DataFrame:
    """(class_id, at, mark), one for a run of frames with the same mark."""
    frames = ", ".join(f"fingerprint[t + {i * GAP}] & {SIGNS}" for i in range(3))
    rows = classes.where(F.size("fingerprint") > 2 * GAP).withColumn("marks", F.expr(f"transform(sequence(0, size(fingerprint) - {2 * GAP + 1}), t -> xxhash64({frames}))"))
    return rows.select("class_id", F.posexplode(F.expr("transform(marks, (m, t) -> if(t > 0 AND m = marks[t - 1], NULL, m))")).alias("at", "mark")).where("mark is not null")


def classed(prints: DataFrame) -> DataFrame:
    """``prints`` with class_id, the smallest id with the same fingerprint; null where there are no
    integers or no id. The recordings are decoded once: what is made of them is a table."""
    prints = written(prints.withColumn("digest", F.when((F.size("fingerprint") > 0) & F.col("id").isNotNull(), F.md5(F.to_json("fingerprint")))))
    named = prints.where("digest is not null")
    names = named.groupBy("digest").agg(F.min("id").alias("class_id"), F.count("*").alias("n"))
    none = prints.where("digest is null").select("id", "fingerprint", F.lit(None).cast("long").alias("class_id"))
    return joined(named, names, ["digest"]).select("id", "fingerprint", "class_id").union(none)


def align(clips: DataFrame, recordings: DataFrame) -> DataFrame:
    """(clip_class, class_id, offset, votes, bit_error): the recordings that clips are from.

    Both tables are (id, class_id, fingerprint) as ``classed`` returns them; pairs are between
    classes. A pair matches if it shares a landmark and at the offset with most votes (the
    frames by which the clip begins later than the recording; of equal ones the smallest) at
    most MAX_ERROR of the bits differ over at least MIN_FRAMES frames.
    """
    heads = lambda df: written(df.where("id = class_id").select("class_id", "fingerprint").dropDuplicates(["class_id"]))
    clips, recordings = heads(clips), heads(recordings)
    asked = _landmarks(clips).select(F.col("class_id").alias("clip_class"), F.col("at").alias("clip_at"), "mark")
    marks = written(_landmarks(recordings))
    # a landmark that very many places have is dealt to copies of its places in the clips
    votes = dealt(marks.withColumn("place", F.xxhash64("class_id", "at")), asked, "mark", "place", marks).groupBy("clip_class", "class_id", (F.col("at") - F.col("clip_at")).alias("offset")).agg(F.count("*").alias("votes"))
    best = votes.groupBy("clip_class", "class_id").agg(F.max(F.struct("votes", (-F.abs("offset")).alias("near"), "offset")).alias("v")).select("clip_class", "class_id", "v.votes", "v.offset")
    pairs = best.join(clips.select(F.col("class_id").alias("clip_class"), F.col("fingerprint").alias("x")), "clip_class").join(recordings.select("class_id", F.col("fingerprint").alias("y")), "class_id")
    pairs = pairs.withColumn("a", F.greatest(-F.col("offset"), F.lit(0))).withColumn("b", F.greatest("offset", F.lit(0)))
    pairs = pairs.withColumn("frames", F.least(F.size("x") - F.col("a"), F.size("y") - F.col("b"))).where(F.col("frames") >= MIN_FRAMES)
    errors = F.expr("aggregate(zip_with(slice(x, a + 1, frames), slice(y, b + 1, frames), (s, t) -> bit_count((s ^ t) & 4294967295L)), 0, (n, e) -> n + e)")
    return pairs.select("clip_class", "class_id", "offset", "votes", (errors / (32 * F.col("frames"))).alias("bit_error")).where(F.col("bit_error") <= MAX_ERROR)


def identify(media: DataFrame, is_query: Column, decode: Callable[[object], np.ndarray], clip: Callable[[np.ndarray], np.ndarray], id_col: str = "id", media_col: str = "media") -> DataFrame:
    """One row per recording: id, class_id, n_frames, is_query, clip_class, matches.

    Rows with ``is_query`` also give a clip, cut by ``clip`` from their samples. Equal clips
    share a clip_class, the smallest of their ids; ``matches`` stands at the row whose id that
    is and lists (class_id, offset, votes, bit_error) of all recordings that the clip matches,
    its own among them. Null, empty and too short media have no integers, no class and no
    matches. Null ids have no class. Repeated rows each get their row. Other columns are not
    looked at. An empty table gives an empty result.
    """
    media = media.select(F.col(id_col).cast("long").alias("id"), F.col(media_col).alias("media"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    whole = written(classed(fingerprints(media, decode)))
    asked = media.where("is_query")
    parts = written(classed(fingerprints(asked, lambda v: clip(decode(v)))))
    found = align(parts, whole).groupBy("clip_class").agg(F.array_sort(F.collect_list(F.struct("class_id", "offset", "votes", "bit_error"))).alias("matches"))
    clips = parts.where("class_id is not null").select("id", F.col("class_id").alias("clip_class")).dropDuplicates(["id"])
    clips = clips.join(found.withColumn("id", F.col("clip_class")).drop("clip_class"), "id", "left")
    queries = asked.select("id").distinct().withColumn("is_query", F.lit(True))
    rows = whole.join(queries, "id", "left").join(clips, "id", "left")
    return rows.select("id", "class_id", F.size("fingerprint").alias("n_frames"), F.coalesce("is_query", F.lit(False)).alias("is_query"), "clip_class", "matches")


def excerpt(samples: np.ndarray) -> np.ndarray:
    """The middle of a recording, beginning between two frames, with noise 20 dB below it."""
    part = samples[len(samples) // 8 + 51 : 7 * len(samples) // 8].astype(np.float64)
    noise = np.random.default_rng(5).standard_normal(len(part))
    return part + 0.1 * noise * np.sqrt((part * part).mean() if len(part) else 0.0)


def _note_table(step: int) -> np.ndarray:
    """A note of ``step`` samples for each of 25 semitones from A3 up, with two overtones."""
    t = np.arange(step) / RATE
    hz = 220 * 2 ** (np.arange(25) / 12)
    wave = sum(np.sin(2 * np.pi * k * hz[:, None] * t) / k for k in (1, 2, 3))
    return (wave * np.hanning(step) ** 0.25).astype(np.float32)


@cache
def _notes() -> np.ndarray:
    return _note_table(512)


def sonify(vector: list[float]) -> np.ndarray:
    """The recording of a vector: one note per coordinate, its pitch by its size relative to the vector's root mean square."""
    v = np.nan_to_num(np.asarray([x if x is not None else 0.0 for x in vector], dtype=np.float64))
    scale = np.sqrt((v * v).mean()) or 1.0
    pitch = np.clip(np.round(12 + 5 * v / scale), 0, 24).astype(int)
    return _notes()[pitch].ravel()
