"""The fixed queries of the training-data operators, and SQL for those that SQL can express.

Each query applies its operator to a whole table with production parameters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import align
from .attention import quality
from .audio import excerpt, identify, sonify
from .base_sql import PII_SQL, SECRETS_SQL, VERSIONS_SQL
from .fingerprints import fingerprint_versions
from .line_dedup import LINES_SQL, dedup_lines
from .manifest import MANIFEST_SQL, audit
from .mixing import MIX_SQL, mix
from .near_dup import NEAR_SQL, near_duplicates
from .packing import pack
from .pii import find_pii
from .secrets import find_secrets
from .shared import table
from .toxicity import toxicity
from .warc import ROUND_TRIP_SQL, round_trip


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_invertible_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_versions(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, whole_runs=True)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents")).drop("found")


def op5_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))


def op6_weighted_fair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op7_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"), min_bytes=0).drop("payload")


def tokenizer_path() -> str:
    """The public byte-level BPE vocabulary of the installed tokenizer files."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_chroma_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recordings that the vectors sound as; every twentieth is also looked for by a noisy excerpt."""
    return identify(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, sonify, excerpt, "vec_id", "embedding")


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level tokens over sentencepiece tokens of every text."""
    import public_tokenizers

    return align(table(spark, sf_dir, "documents"), tokenizer_path(), public_tokenizers.path("piece_bpe_32k.model")).documents.drop("groups")


def op12_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


def op2_invertible_fingerprints_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op2 that SQL can express: likeness comes from peeled sketches here, from the paragraphs there."""
    return op2_invertible_fingerprints(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256", "near_edited", "near_next")


def op4_secret_scan_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op4 that its fixed patterns alone decide."""
    return op4_secret_scan(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def op5_bootstrapped_pii_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op5 that its fixed patterns alone decide."""
    return op5_bootstrapped_pii(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_invertible_fingerprints,
        op3_line_dedup,
        op4_secret_scan,
        op5_bootstrapped_pii,
        op6_weighted_fair_mixing,
        op7_minhash_near_dup,
        op8_warc_normaliser,
        op9_best_fit_packing,
        op10_chroma_fingerprints,
        op11_tokenizer_alignment,
        op12_attention_quality,
        op13_merkle_manifest,
        op2_invertible_fingerprints_base,
        op4_secret_scan_base,
        op5_bootstrapped_pii_base,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op3_line_dedup": LINES_SQL,
    "op6_weighted_fair_mixing": MIX_SQL,
    "op7_minhash_near_dup": NEAR_SQL,
    "op8_warc_normaliser": ROUND_TRIP_SQL,
    "op13_merkle_manifest": MANIFEST_SQL,
    "op2_invertible_fingerprints_base": VERSIONS_SQL,
    "op4_secret_scan_base": SECRETS_SQL,
    "op5_bootstrapped_pii_base": PII_SQL,
}
