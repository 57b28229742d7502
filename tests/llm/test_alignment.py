"""Alignment of two tokenizers against the two libraries and loops over all token pairs."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quarry.llm.alignment import align, links, load_pair

from tests.conftest import SF_SMALL

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pair(spark):
    return load_pair(spark, A, B, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    letters = {chr(b) if b in {*range(33, 127), *range(161, 173), *range(174, 256)} else None: b for b in range(256)}
    letters.pop(None)
    n = 0
    for b in range(256):
        if b not in letters.values():
            letters[chr(256 + n)] = b
            n += 1
    return a, sentencepiece.SentencePieceProcessor(model_file=B), letters


def tokens(libraries, text):
    """(id, start, end) of both sides, or nothing where they don't spell the text."""
    a, b, letters = libraries
    if not text:
        return [], []
    whole = (" " + text).encode()
    sides = []
    for ids, spell in ((a.encode(" " + text, add_special_tokens=False).ids, lambda i: bytes(letters[c] for c in a.id_to_token(i))),
                       (b.encode(text), lambda i: bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())):
        out, at = [], 0
        for i in ids:
            out.append((i, at, at + len(spell(i))))
            at = out[-1][2]
        if b"".join(map(spell, ids)) != whole:
            return [], []
        sides.append(out)
    return tuple(sides)


def brute_force(libraries, rows):
    found, counts = [], {}
    for doc_id, text in rows:
        a, b = tokens(libraries, text)
        pairs = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        for p in set(pairs):
            counts[p] = counts.get(p, 0) + 1
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        groups = ["|".join(",".join(str(t[0]) for t in side if lo < t[2] <= hi) for side in (a, b)) for lo, hi in zip([0, *ends], ends)]
        found.append((doc_id, len(a), len(b), len(groups), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    top = {}
    for (a, _), n in counts.items():
        top[a] = max(top.get(a, 0), n)
    return sorted((d, na, nb, ng, len(ps), sum(counts[p] == top[p[0]] for p in ps), sum(counts[p] for p in ps), digest)
                  for d, na, nb, ng, ps, digest in found)


def spark_rows(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())


EDGES = ["", None, " ", "\n", "▁ a", "a\x00b", "é", "é x", "ﬁne", "  two  spaces \t tab\r\n a\xa0b", "<|endoftext|> <s> <unk>", "日本語 text",
         "😀 smile's it's WE'LL", "hello world", "hello world", "x" * 3000, " " * 5000 + "x", "\n" * 3000, "12345 678"]


def test_edge_texts(spark, pair, libraries):
    rows = [(i // 2, t) for i, t in enumerate(EDGES)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("block", F.lit("clash")).withColumn("pairs", F.lit(1))
    assert spark_rows(align(df.repartition(3), pair)) == brute_force(libraries, rows)


def test_blocks_and_given_documents(spark, pair, libraries):
    """Many small blocks give the counts of the whole corpus; copies count as documents."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").where("length(text) < 4000")
    rows = [tuple(r) for r in docs.collect()]
    assert spark_rows(align(docs, pair, block_bytes=20_000)) == brute_force(libraries, rows)


def test_links(spark, pair, libraries):
    rows = [(7, "it's an unalignable tokenization"), (8, None), (9, "été 12")]
    got = sorted(tuple(r) for r in links(spark.createDataFrame(rows, "doc_id long, text string"), pair).collect())
    expected = []
    for doc_id, text in rows:
        a, b = tokens(libraries, text)
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        expected += [(doc_id, i, x[0], j, y[0], sum(e < x[2] for e in ends)) for i, x in enumerate(a) for j, y in enumerate(b)
                     if x[1] < y[2] and y[1] < x[2]]
    assert got == sorted(expected)


def test_empty_table(spark, pair):
    assert align(spark.createDataFrame([], "doc_id long, text string"), pair).count() == 0
