"""Packing tokenised documents into training sequences by the sum-of-squares rule.

Tokenising is one pass over the texts; what moves on is a few numbers per piece. Pieces are
dealt by hash into shards of bounded size. Each shard places its pieces longest first: among
the open sequences that can take a piece, it goes where the squared counts of open sequences
per residual gap become smallest, and a new sequence starts only if no open one has room.
A shard leaves less than a few sequences unfilled, whatever the input size.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import two_columns, written

#: Pieces in a shard, on average.
SHARD = 30_000


#: Splits text before the merges of byte-level BPE (fixed value of the public vocabulary).
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_char() -> dict[str, int]:
    """Byte-level BPE writes printable bytes as themselves and the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@cache
def _encoders(path: str):
    """Encode a text to ids. The vocabulary file is read by tiktoken's merge routine, several
    times as fast as that of tokenizers and equal in its ids; texts that hold the literal
    text of a special token go to tokenizers itself."""
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec.get("added_tokens", [])}
    byte = _byte_of_char()
    ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    fast = tiktoken.Encoding("bpe", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})
    slow = Tokenizer.from_file(path)

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special):
            return np.array(slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return np.array(fast.encode_ordinary(text), dtype=np.uint32)

    return encode


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: whole if they fit, else full ones after a first that may be shorter."""
    first = n if n <= size else n % size or size
    return [(0, first), *((s, size) for s in range(first, n, size))]


def _pieces(path: str, size: int, end_id: int):
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoders(path)
        for batch in batches:
            rows = []
            for row, doc, text in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.append(encode(text.as_py()), np.uint32(end_id)).astype("<u4")
                rows += [(row, doc, i, a, n, zlib.crc32(ids[a : a + n])) for i, (a, n) in enumerate(cut(len(ids), size))]
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return run, "row long, doc_id long, piece int, start long, length long, ids_crc32 long"


def place(lengths: list[int], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each length, taken in the given order."""
    open_at: list[list[int]] = [[] for _ in range(size + 1)]  # by residual gap
    count = np.zeros(size + 1, dtype=np.int64)
    sequence, offset, sequences = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for i, n in enumerate(lengths):
        gaps = np.flatnonzero(count[n:size]) + n
        if len(gaps):
            left = gaps - n
            # moving a sequence from gap g to g - n changes the sum of squares by this; full ones don't count
            change = 1 - 2 * count[gaps] + np.where(left > 0, 2 * count[left] + 1, 0)
            gap = int(gaps[change.argmin()])
            s = open_at[gap].pop()
            count[gap] -= 1
        else:
            gap, s = size, sequences
            sequences += 1
        sequence[i], offset[i] = s, size - gap
        if gap > n:
            open_at[gap - n].append(s)
            count[gap - n] += 1
    return sequence, offset


def _pack(size: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "start", "ids_crc32"], ascending=[False, True, True, True, True], kind="stable")
        sequence, offset = place(rows.length.tolist(), size)
        return rows.assign(sequence_id=sequence + (int(key[0]) << 36), offset=offset)[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    return run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = 1024, end_id: int = 2, shard: int = SHARD) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is the ids of its text and then ``end_id``; only one longer than ``size`` is
    cut, into pieces of ``size`` ids after a first that may be shorter. No sequence holds more
    than ``size`` ids, and its pieces lie one after the other from 0. A null text is empty
    (one id). Rows that repeat an id are documents of their own; a null id stays null. An
    empty table gives an empty result. ``tokenizer_path`` must exist on every machine.
    """
    run, schema = _pieces(tokenizer_path, size, end_id)
    # the number spreads rows that repeat an id and text over the shards
    pieces = written(two_columns(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()).mapInArrow(run, schema))
    shards = max(1, -(-pieces.count() // shard))
    run, schema = _pack(size)
    return pieces.withColumn("shard", F.pmod(F.xxhash64("row", "doc_id", "piece", "ids_crc32"), F.lit(shards))).groupBy("shard").applyInPandas(run, schema)
