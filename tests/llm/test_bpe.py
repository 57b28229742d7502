"""BPE against the tiktoken library on the same rank file."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from quarry.llm.bpe import Encoder, Ranks, encode, load_ranks, round_trip, slice_starts

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [None, "", " ", "  ", "\n", " \n ", "a", "'", "''s", "it's 'tis I'll we've they'RE x'd'd 're ' s'", "a  b   c\t\td\r\n\r\ne  ",
       "1234567 12a34", "!!!'s ??'ll (don't)", " x  y　", "日本語テキスト　です", "é Ⅳ ½ ٣٤", "😀👍🏽 family",
       "x" * 3000, "ab" * 5000, " " * 5000 + "z", "<|endoftext|> is text", "\x1c\x1f\x00\x85z", "naïve façade — “quoted”…"]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def ranks():
    return Ranks.of_file(PATH)


def random_texts(seed, n):
    rng = random.Random(seed)
    parts = ["'s", "'ll", "'", " ", "  ", "\n", "\t", "a", "Bc", "the ", "7", "42", "é", "ß", "—", "!", "##", "日", " ", "I'd", "😀"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_ids_equal_the_library(reference, ranks):
    encoder = Encoder(ranks)
    texts = [t or "" for t in ODD] + random_texts(1, 600)
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    for _ in range(2):  # new slices, then cached ones
        ids, count, ends = encoder.encode(data, offsets)
        at = np.concatenate([[0], np.cumsum(count)])
        for i, t in enumerate(texts):
            assert ids[at[i]:at[i + 1]].tolist() == reference.encode_ordinary(t), t[:80]
    assert ends[-1] == len(data)


def test_cache_limit_does_not_change_ids(reference, ranks):
    encoder = Encoder(ranks)
    encoder.LIMIT = 5
    for t in random_texts(2, 50):
        raw = t.encode()
        ids, _, _ = encoder.encode(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        assert ids.tolist() == reference.encode_ordinary(t)


def test_slices_do_not_depend_on_the_block(ranks):
    points = np.frombuffer("".join(random_texts(3, 40)).encode("utf-32-le"), np.uint32)
    first = np.array([0, 17, 400])
    whole = slice_starts(points, first, ranks.kinds, 4096)
    for block in (1, 2, 7, 256):
        assert (slice_starts(points, first, ranks.kinds, block) == whole).all()


def test_round_trip_rows(spark, reference):
    rows = [(i, t, "x", "y") for i, t in enumerate(ODD)] + [(0, None, "x", "y"), (None, "null id", "x", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded string").repartition(3)
    out = {(r[0], r[1:]) for r in map(tuple, round_trip(df, PATH).collect())}
    want = set()
    for d, t, *_ in rows:
        ids = reference.encode_ordinary(t or "")
        want.add((d, (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())))
    assert out == want
    assert round_trip(df.limit(0), PATH).count() == 0


def test_offsets_give_back_every_token(spark, reference):
    text = "Offsets: naïve — 日本 it's"
    row = encode(spark.createDataFrame([(1, text)], "doc_id long, text string"), load_ranks(spark, PATH), with_offsets=True).first()
    ids, ends = np.frombuffer(row.ids, "<u4"), np.frombuffer(row.ends, "<u4")
    begins = np.concatenate([[0], ends[:-1]])
    assert [text.encode()[a:b] for a, b in zip(begins, ends)] == [reference.decode_single_token_bytes(int(i)) for i in ids]
