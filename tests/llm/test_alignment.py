"""Alignment against the tokenizer libraries themselves and a direct walk over the tokens."""

import hashlib
from collections import Counter

import public_tokenizers as P
import pytest
from helpers import awkward, documents, empty

from millrace.llm.alignment import align

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = ["<|endoftext|> in <s> a text </s>", "tabs\tand\n\n lines  and   blanks ", "a▁b", "<0x41> é😀 日本語  ", " lead", "x" * 3000, "\x00"]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}

    def cut(text):
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        return ids_a, bytes_a, ids_b, bytes_b

    return cut


def walk(cut, text):
    """(n_a, n_b, links, groups) by one position after the other."""
    if not text:
        return 0, 0, [], ""
    ids_a, bytes_a, ids_b, bytes_b = cut(text)
    whole = (" " + text).encode()
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return 0, 0, [], ""
    links, groups, i, j, end_a, end_b, left, right = [], [], 0, 0, len(bytes_a[0]), len(bytes_b[0]), [ids_a[0]], [ids_b[0]]
    while True:
        links.append((ids_a[i], ids_b[j]))
        was_a, was_b = end_a, end_b
        if was_a == was_b:
            groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
            left, right = [], []
            if was_a == len(whole):
                return len(ids_a), len(ids_b), links, ";".join(groups)
        if was_a <= was_b:
            i += 1
            end_a += len(bytes_a[i])
            left.append(ids_a[i])
        if was_b <= was_a:
            j += 1
            end_b += len(bytes_b[j])
            right.append(ids_b[j])


def brute(cut, rows):
    each = [(doc, *walk(cut, text)) for doc, text in rows]
    count = Counter(p for _, _, _, links, _ in each for p in set(links))
    most = {}
    for (a, _), n in count.items():
        most[a] = max(most.get(a, 0), n)
    out = [(doc, na, nb, g.count(";") + 1 if g else 0, len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), hashlib.sha256(g.encode()).hexdigest() if g else "", g) for doc, na, nb, links, g in each]
    return out, {(a, b, n, n == most[a]) for (a, b), n in count.items()}


def check(spark, cut, df, rows, **options):
    got, (want, pairs) = align(df, A, B, keep_groups=True, **options), brute(cut, rows)
    assert sorted(map(str, map(tuple, got.documents.collect()))) == sorted(map(str, want))
    assert {tuple(r) for r in got.pairs.collect()} == pairs


def test_documents_and_odd_texts(spark, libraries):
    odd = spark.createDataFrame(list(enumerate([*ODD, ODD[0], "", None], 10_000_000)), "doc_id long, text string")
    df = documents(spark).select("doc_id", "text").union(odd)
    check(spark, libraries, df, [tuple(r) for r in df.collect()])


def test_blocks_of_few_tokens(spark, libraries):
    """Pairs of many small blocks add up to the same counts."""
    df = documents(spark).select("doc_id", "text").where("length(text) < 3000").repartition(3)
    check(spark, libraries, df, [tuple(r) for r in df.collect()], block_tokens=500)


def test_a_third_of_the_rows_is_one_text(spark, libraries):
    df = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'the same few words' ELSE concat('words of ', id % 40) END AS text")
    check(spark, libraries, df, [tuple(r) for r in df.collect()])


def test_awkward_rows(spark, libraries):
    df = awkward(spark)
    check(spark, libraries, df, [(r.doc_id, r.text) for r in df.collect()])
    nothing = align(empty(spark), A, B)
    assert nothing.documents.count() == nothing.pairs.count() == 0
    assert nothing.documents.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
