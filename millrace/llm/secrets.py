"""Secrets in texts: fixed patterns, and novelty under a primed zstandard dictionary.

A token in a sensitive context (an assignment to a name like key or credential, an
authorisation header, a connection string) is a secret if it cannot be guessed from what
surrounds it. That is measured: the text around the token is compressed with a dictionary, then
the same text with the token in its place; the growth is what the token costs. Placeholders,
paths and names repeat what the dictionary or the surroundings hold and cost little; random
strings cost nearly their entropy.

The dictionary holds words of code, and the identifiers of the corpus: a first pass over all
texts counts, for every run of letters, the distinct words before it. Words of a language or a
code base follow many others; the letters of one secret always follow the same ones, however
often its document is copied, and stay out.

Candidates overlap: each name is looked at with what follows it, also inside the token of a
name before it. The second pass goes over each text once; no rows move.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import two_columns, written

#: The base kinds, in the order in which they are listed. Letters of the names in either case, ASCII only.
ASSIGN = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "novel")

#: A name; what stands between it and its token (an assignment with or without a type, or blanks); a token.
_NAME = re.compile(r"[A-Za-z0-9_.-]+")
_BETWEEN = re.compile(r"[\"'`]?+\]?+(?:[ \t]*+(?::[ \t]*+[A-Za-z_][A-Za-z0-9_.\[\]]*+[ \t]*+=|=>|:=|[:=])|[ \t])[ \t]*+[\"'`]?+")
_TOKEN = re.compile(r"[A-Za-z0-9+/_=~!@#$%^&*.-]{12,}+")
#: Where a name in camel case has its next word.
_HUMP = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])")
#: The password of a connection string.
_CONNECTION = re.compile(r"(?<=://)[^\s:/?#@\"'`<>]*:([^\s/@\"'`<>]{12,})@")
_SENSITIVE = re.compile(r"(?:^|[_.-])(?:key|auth|authorization|bearer|basic|cred|creds|credential|credentials|pwd|pass|passphrase|private|signature|sig|salt|jwt|session|cookie|hmac|secret|token|password|passwd|apikey|dsn|sas)(?:$|[_.-])", re.A | re.I)
#: A cheap necessary condition for a sensitive name.
_WORDS = ("key", "auth", "bearer", "basic", "cred", "pwd", "pass", "private", "sig", "salt", "jwt", "session", "cookie", "hmac", "secret", "token", "dsn", "sas")

#: Code and configuration words that tokens are often made of (fixed values).
DICTIONARY = " ".join(
    """
    function return const class public private static import export default require module self this null none true false undefined
    password passwd secret token api_key apikey access_key secret_key private_key public_key client_secret client_id refresh_token
    authorization bearer basic credential credentials username user admin root localhost example test sample dummy placeholder
    changeme change_me your_password_here your_api_key_here YOUR_TOKEN_HERE INSERT_KEY_HERE xxxxxxxxxxxxxxxx XXXXXXXXXXXXXXXX
    0000000000000000 1234567890123456 0123456789abcdef abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ
    process.env.SECRET os.environ["TOKEN"] getenv config.get settings.SECRET_KEY environment variable vault ssm parameter
    http https www com org net io dev local host port path file dir home usr bin etc var log tmp lib src main index app server
    client request response header content type application json text html utf-8 session cookie signature salt hash sha256 md5
    -----BEGIN PRIVATE KEY----- -----END PRIVATE KEY----- ssh-rsa-AAAAB3NzaC1yc2E license version copyright apache
    """.split()
)

#: Code points on either side of a token that count as what surrounds it.
CONTEXT = 256
#: Most common words of the corpus in the dictionary, and the distinct words that one must follow.
DICTIONARY_WORDS, MIN_FOLLOWED = 4_000, 20
#: Compressed bytes that a token must add for each of its own, and in all, to be reported.
MIN_RATIO, MIN_BYTES = 0.85, 11
#: Characters of the shortest token: shorter ones cost fewer bytes than MIN_BYTES however random they are.
MIN_TOKEN = 12


def identifiers(texts: DataFrame, size: int = DICTIONARY_WORDS) -> str:
    """The ``size`` runs of letters of a table (text) that follow most distinct words, the most common last."""
    words = F.regexp_extract_all("text", F.lit("[A-Za-z]++"), F.lit(0))
    pairs = texts.select(F.explode(F.filter(F.transform(F.array(words), lambda w: F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.size(w)), lambda a, b: F.struct(a.alias("before"), b.alias("word"))))[0], lambda p: F.length(p["word"]) >= 3)).alias("p"))
    counts = pairs.groupBy("p.word").agg(F.approx_count_distinct("p.before", 0.1).alias("n")).where(F.col("n") >= MIN_FOLLOWED)
    # ties are told apart by a hash; a percentile leaves about ``size`` words to be ordered, from all tasks together
    counts = written(counts.withColumn("rank", F.col("n") * 1e6 + F.pmod(F.xxhash64("word"), F.lit(1_000_000))))
    total = counts.count()
    if total > 2 * size:
        cut = counts.agg(F.percentile_approx("rank", 1 - 1.1 * size / total, 100_000)).first()[0]
        counts = counts.where(F.col("rank") >= cut)
    return " ".join(r["word"] for r in reversed(counts.orderBy(F.desc("rank"), "word").limit(size).collect()))


@cache
def _compressor(words: str):
    import zstandard

    content = zstandard.ZstdCompressionDict(f"{words} {DICTIONARY}".encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    # with this strategy literals are stored as they are, so a token's cost does not hang on the others' statistics
    params = zstandard.ZstdCompressionParameters(strategy=zstandard.STRATEGY_FAST, target_length=1, min_match=4, hash_log=17, chain_log=16, search_log=1, window_log=18, write_content_size=0, write_checksum=0, write_dict_id=0)
    return zstandard.ZstdCompressor(compression_params=params, dict_data=content)


def novelty(before: str, token: str, after: str = "", words: str = "") -> int:
    """Bytes by which the token lengthens what surrounds it, compressed under a dictionary of words."""
    c = _compressor(words)
    return len(c.compress((before + token + after).encode("utf-8", "replace"))) - len(c.compress((before + after).encode("utf-8", "replace")))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, in code points, by start and then kind.

    Each kind is matched leftmost and without overlap; a match that fails its condition is
    dropped, and what it covers is not looked at again.
    """
    spans = []
    if ":" in text or "=" in text:
        spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def _sensitive(name: str) -> bool:
    return bool(_SENSITIVE.search(name) or _SENSITIVE.search(_HUMP.sub("_", name)))


def _mixed(token: str) -> bool:
    return bool(re.search("[0-9]", token)) + bool(re.search("[a-z]", token)) + bool(re.search("[A-Z]", token)) >= 2


def novel_spans(text: str, known: list[tuple[str, int, int]], words: str = "") -> list[tuple[str, int, int]]:
    """Incompressible tokens in a sensitive context that no known span overlaps."""
    low = text.lower()
    if "://" not in text and not any(w in low for w in _WORDS):
        return []
    taken = sorted((a, b) for _, a, b in known)
    ends = list(accumulate((b for _, b in taken), max))
    out: list[tuple[str, int, int]] = []

    def judged(a: int, token: str) -> bool:
        b = a + len(token)
        i = bisect_left(taken, (b,))  # known spans that begin before the token's end
        if i and ends[i - 1] > a:
            return False
        cost = novelty(text[max(0, a - CONTEXT) : a], token, text[b : b + CONTEXT], words)
        if cost < MIN_BYTES or cost < MIN_RATIO * len(token):
            return False
        out.append(("novel", a, b))
        return True

    if "://" in text:
        for m in _CONNECTION.finditer(text):
            judged(m.start(1), m[1])
        taken = sorted([*taken, *((a, b) for _, a, b in out)])
        ends = list(accumulate((b for _, b in taken), max))
    reached = 0
    for m in _NAME.finditer(text):
        if m.end() <= reached:  # inside a token that was found
            continue
        between = _BETWEEN.match(text, m.end())
        if not between or not _sensitive(m[0]):
            continue
        t = _TOKEN.match(text, between.end())
        token = t[0].rstrip(".!?&%#*$,") if t else ""  # sentence and mark-up ends are not part of it
        # after blanks alone, as in prose, a word of one kind of characters is the next word, not what the name holds
        if len(token) >= MIN_TOKEN and (between[0].strip() or _mixed(token)) and judged(t.start(), token):
            reached = t.start() + len(token)
    return sorted(out, key=lambda s: s[1])


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _scan(words: str):
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, every, digest = [], [], []
            for text in batch.column("text"):
                text = text.as_py()
                spans = base_spans(text)
                more = novel_spans(text, spans, words)
                base.append([sum(k == kind for k, _, _ in spans) for kind in KINDS[:3]] + [len(more)])
                digest.append(hashlib.sha256(_joined(spans).encode()).hexdigest())
                every.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in sorted(spans + more, key=lambda s: (s[1], KINDS.index(s[0])))])
            counts = [pa.array([r[i] for r in base], pa.int64()) for i in range(4)]
            joined = [",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in r) for r in every]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, pa.array(digest, pa.string()), pa.array(joined, pa.string()), pa.array(every, span)], ["doc_id", "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans", "found"])

    return run, "doc_id long, n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string, found array<struct<kind:string,start:long,end:long>>"


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dictionary_words: int = DICTIONARY_WORDS) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, n_novel, base_sha256, spans, found.

    ``found`` has all spans as (kind, start, end) in code points, end exclusive, by start and
    then kind; ``spans`` is the same as text, and base_sha256 digests those of the fixed
    patterns. The dictionary of the novelty measure has the ``dictionary_words`` words of this
    table that follow most others. A null text is empty and has none. Rows that repeat an id get
    a row each, a null id stays null, other columns are not looked at. An empty table gives an
    empty result.
    """
    docs = two_columns(docs, id_col, text_col)
    run, schema = _scan(identifiers(docs, dictionary_words))
    return docs.mapInArrow(run, schema)
