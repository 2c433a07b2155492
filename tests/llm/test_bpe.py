import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pavilion.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
RANKS = bpe.read_ranks(PATH)
ROWS = [
    (1, "Hello, world! It's 2024, isn't it?\n\n  x"), (2, None), (3, ""), (4, "  \n\n  'll" * 400), (4, "  \n\n  'll" * 400),
    (4, "same id, other text"), (None, "é" * 2500 + " ñ 日本語 🙂🙂"), (5, "a" * 4000 + "   " * 90 + "\n\nx 'ree" * 200), (6, "\x00\x01 <|endoftext|>"),
]


def reference(text):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = own.encode_ordinary(text or "")
    digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    return len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()


@pytest.mark.parametrize("chunks", [{}, {"chunk": 300, "overlap": 40}, {"chunk": 64, "overlap": 20}])
def test_ids_and_round_trip(spark, chunks):
    docs = spark.createDataFrame([(*r, "x", 7) for r in ROWS], "doc_id long, text string, ids string, __n int")
    got = sorted(map(tuple, bpe.digests(docs, PATH, PATTERN, **chunks).collect()), key=str)
    assert got == sorted([(i, *reference(t)) for i, t in ROWS], key=str)


def test_decode_is_the_inverse(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    rows = bpe.decode(bpe.encode(docs, PATH, PATTERN), PATH).collect()
    assert sorted(bytes(r.decoded) for r in rows) == sorted((t or "").encode() for _, t in ROWS)


def test_both_merges_agree():
    rng = random.Random(1)
    for _ in range(200):
        piece = "".join(rng.choice("aab the ing é") for _ in range(rng.randrange(1, 60))).encode()
        assert bpe.merge_short(piece, RANKS) == bpe.merge_long(piece, RANKS)


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sorted(map(tuple, bpe.digests(docs, PATH, PATTERN).collect()))
    assert got == sorted((r.doc_id, *reference(r.text)) for r in docs.collect())
