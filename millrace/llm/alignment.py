"""Two tokenizers over the same texts: which tokens of one lie on which tokens of the other.

Each distinct text is tokenised and aligned once:

1. *Deduplication.* A shuffle by the full text leaves every text once, with the number of its rows.
2. *Alignment.* Both encoders cut the same bytes, so their tokens are two lists of end offsets. Each
   stretch between neighbouring ends of either list lies in one token of each: that is a link. Ends
   that both lists have cut the text into groups.
3. *Pair counts.* The distinct pairs of a text weigh as many documents as have the text.
   Texts lie in blocks of bounded size; a block adds up its own pairs before anything moves, so a
   pair that stands in all texts is one row per block.
4. *Measures.* The counts go back to the blocks that asked for them, one row per block and pair, and
   each text sums over its links. Documents find their text's measures by its digest.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import _SPLIT, _byte_of_char
from .shared import joined, two_columns, written

#: Tokens of the first encoder in a block; the text that reaches it is the block's last.
BLOCK_TOKENS = 8_000_000
#: Pairs that are gathered before they are added up.
PAIRS_AT_ONCE = 4_000_000

_U = np.uint64
_LOW = _U(0xFFFFFFFF)


@cache
def byte_level(path: str):
    """(encode, bytes of each id) of a byte-level BPE file. All text is plain text, that of special
    tokens too. The merges are tiktoken's, on the vocabulary of the file."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec.get("added_tokens", [])}
    byte, vocab = _byte_of_char(), spec["model"]["vocab"]
    ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items() if token not in special}
    table = [b""] * (max(vocab.values()) + 1)
    for token, i in ranks.items():
        table[i] = token
    return tiktoken.Encoding("plain", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, table


@cache
def pieces(path: str):
    """(encode, bytes of each id) of a sentencepiece model with byte fallback."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    table = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
    return lambda text: model.encode(text, num_threads=1), table


class Aligner:
    """Aligns texts under a byte-level BPE file (which sees a space before the text) and a
    sentencepiece model (which adds one itself)."""

    def __init__(self, byte_path: str, piece_path: str):
        self.encode_a, self.bytes_a = byte_level(byte_path)
        self.encode_b, self.bytes_b = pieces(piece_path)
        self.length_a = np.array([len(x) for x in self.bytes_a])
        self.length_b = np.array([len(x) for x in self.bytes_b])
        # an id with what follows it: a comma in its group, a bar after the last of the first encoder's, a semicolon after the group
        self.shown = [f"{i}{end}" for i in range(max(len(self.bytes_a), len(self.bytes_b))) for end in ",|;"]

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, str] | None:
        """(ids of the first, ids of the second, distinct pairs as first << 32 | second in order, links of
        each, groups as text), or None if the tokens of either don't spell the text."""
        want = b" " + text.encode()
        a, b = self.encode_a(" " + text), self.encode_b(text)
        if b"".join([self.bytes_a[i] for i in a]) != want or b"".join([self.bytes_b[i] for i in b]) != want:
            return None
        a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        every = np.union1d(end_a, end_b)
        links = a[np.searchsorted(end_a, every)].astype(_U) << _U(32) | b[np.searchsorted(end_b, every)].astype(_U)
        distinct, times = np.unique(links, return_counts=True)
        return a, b, distinct, times, self._groups(a, b, end_a, end_b, both)

    def _groups(self, a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray, both: np.ndarray) -> str:
        of_a, of_b = np.searchsorted(both, end_a), np.searchsorted(both, end_b)
        parts = np.empty(len(a) + len(b), dtype=np.int64)
        # tokens stand by group, those of the first encoder before those of the second
        parts[np.arange(len(a)) + np.searchsorted(of_b, of_a)] = 3 * a + (both[of_a] == end_a)
        parts[np.arange(len(b)) + np.searchsorted(of_a, of_b, "right")] = 3 * b + 2 * (both[of_b] == end_b)
        shown = self.shown
        return "".join([shown[i] for i in parts.tolist()])[:-1]


def _packed(pairs: np.ndarray, times: np.ndarray, compressor) -> bytes:
    first, second = (pairs >> _U(32)).astype("<u4"), (pairs & _LOW).astype("<u4")
    return compressor.compress(np.concatenate([np.diff(first, prepend=np.uint32(0)), second, times.astype("<u4")]).tobytes())


def _unpacked(blob: bytes, decompressor) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(decompressor.decompress(blob), dtype="<u4")
    n = len(x) // 3
    return np.cumsum(x[:n], dtype=_U) << _U(32) | x[n : 2 * n].astype(_U), x[2 * n :].astype(np.int64)


_TEXTS = pa.schema(
    [("text_id", pa.binary()), ("n", pa.int64()), ("block", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("groups", pa.string()), ("pairs", pa.binary())]
)
_TEXTS_SQL = "text_id binary, n long, block long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, pairs binary"


def _align(byte_path: str, piece_path: str, keep_groups: bool, block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        aligner, compressor = Aligner(byte_path, piece_path), zstandard.ZstdCompressor(level=1)
        held, number = 0, 0  # of the open block, which is known by its partition and its number there
        for batch in batches:
            rows = []
            for text, n, part in zip(batch.column("text"), batch.column("n").to_pylist(), batch.column("part").to_pylist(), strict=True):
                text = text.as_py()
                key, found = hashlib.sha256(text.encode()).digest(), aligner(text)
                if held >= block_tokens:
                    held, number = 0, number + 1
                block = (part << 32) + number
                if found is None:
                    rows.append((key, n, block, 0, 0, 0, 0, "", "", b""))
                    continue
                a, b, pairs, times, groups = found
                held += len(a)
                rows.append((key, n, block, len(a), len(b), groups.count(";") + 1, int(times.sum()), hashlib.sha256(groups.encode()).hexdigest(), groups if keep_groups else None, _packed(pairs, times, compressor)))
            cols = list(zip(*rows, strict=True)) or [[]] * len(_TEXTS)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, _TEXTS, strict=True)], schema=_TEXTS)

    return run, _TEXTS_SQL


def _added(pairs: list[np.ndarray], weights: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    distinct, at = np.unique(np.concatenate(pairs), return_inverse=True)
    sums = np.zeros(len(distinct), np.int64)
    np.add.at(sums, at, np.concatenate(weights))
    return [distinct], [sums]


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, a, b, docs) of the texts at hand; a block that two tasks read has its pairs from both."""
    import zstandard

    decompressor, block, pairs, weights, size = zstandard.ZstdDecompressor(), None, [], [], 0

    def out() -> Iterator[pa.RecordBatch]:
        if pairs:
            (found,), (docs,) = _added(pairs, weights)
            for i in range(0, len(found), 1 << 16):
                p = found[i : i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(p), block, np.int64)), pa.array((p >> _U(32)).astype(np.int32)), pa.array((p & _LOW).astype(np.int32)), pa.array(docs[i : i + (1 << 16)])], ["block", "a", "b", "docs"])

    for batch in batches:
        for at, n, blob in zip(batch.column("block").to_pylist(), batch.column("n").to_pylist(), batch.column("pairs").to_pylist(), strict=True):
            if not blob:
                continue
            if at != block:
                yield from out()
                block, pairs, weights, size = at, [], [], 0
            mine, _ = _unpacked(blob, decompressor)
            pairs.append(mine)
            weights.append(np.full(len(mine), n, np.int64))
            size += len(mine)
            if size >= PAIRS_AT_ONCE:
                pairs, weights = _added(pairs, weights)
                size = 0
    yield from out()


_MEASURES_SQL = "text_id binary, n long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"


def _measure(texts: pa.Table, counts: pa.Table) -> pa.Table:
    """The texts of a block, with what the counts of the block's pairs make of their links."""
    import zstandard

    decompressor = zstandard.ZstdDecompressor()
    keys = counts.column("a").to_numpy().astype(_U) << _U(32) | counts.column("b").to_numpy().astype(_U)
    order = np.argsort(keys)
    keys, docs, best = keys[order], counts.column("docs").to_numpy()[order], counts.column("best").to_numpy(zero_copy_only=False)[order]
    n_best, count_sum = [], []
    for blob in texts.column("pairs").to_pylist():
        if not blob:
            n_best.append(0)
            count_sum.append(0)
            continue
        pairs, times = _unpacked(blob, decompressor)
        at = np.searchsorted(keys, pairs)
        n_best.append(int(times[best[at]].sum()))
        count_sum.append(int((times * docs[at]).sum()))
    kept = texts.select(["text_id", "n", "n_a", "n_b", "n_groups", "n_links"])
    return kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64())).append_column("groups_sha256", texts.column("groups_sha256")).append_column("groups", texts.column("groups"))


@dataclass
class Alignment:
    #: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, groups; a row per document.
    documents: DataFrame
    #: a, b, docs, best: the documents that hold the pair linked, and whether that is the most for ``a``.
    pairs: DataFrame


def align(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text", keep_groups: bool = False, block_tokens: int = BLOCK_TOKENS) -> Alignment:
    """Tokens of a byte-level BPE (ids ``a``) over those of a sentencepiece model (ids ``b``).

    The first encoder sees a space and the text; the second adds that space itself. Texts that are
    null or empty, or that the tokens of either encoder don't spell byte for byte, have no tokens:
    all their numbers are 0 and their groups are ''. ``groups`` has the ids by group, as in
    ``a1,a2|b1;a3|b2,b3``, if ``keep_groups`` asks for it, else null; groups_sha256 digests that text.
    A pair counts once for each row whose text holds it linked; rows that repeat an id are
    documents of their own, a null id stays null. Other columns are not looked at. An empty table
    gives empty results. Both files must exist on every machine.
    """
    docs = two_columns(docs, id_col, text_col)
    distinct = docs.where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("n"))
    run, schema = _align(byte_path, piece_path, keep_groups, block_tokens)
    texts = written(distinct.select("text", "n", F.spark_partition_id().alias("part")).mapInArrow(run, schema))
    asked = written(texts.select("block", "n", "pairs").mapInArrow(_block_pairs, "block long, a int, b int, docs long"))
    counts = written(asked.groupBy("a", "b").agg(F.sum("docs").alias("docs")))
    # a row for each id of the first vocabulary at most
    most = F.broadcast(counts.groupBy("a").agg(F.max("docs").alias("most")))
    pairs = written(counts.join(most, "a").select("a", "b", "docs", (F.col("docs") == F.col("most")).alias("best")))
    answers = asked.select("block", "a", "b").join(pairs, ["a", "b"]).groupBy("block")
    measures = texts.groupBy("block").cogroup(answers).applyInArrow(_measure, _MEASURES_SQL)
    rows = written(docs.select("doc_id", F.when(F.col("text") != "", F.unhex(F.sha2("text", 256))).alias("text_id")))
    numbers = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    none = rows.where("text_id is null").select("doc_id", *(F.lit(0).cast("long").alias(c) for c in numbers), F.lit("").alias("groups_sha256"), F.lit("" if keep_groups else None).cast("string").alias("groups"))
    found = joined(rows.where("text_id is not null"), measures, ["text_id"])
    return Alignment(found.select(none.columns).union(none), pairs)
