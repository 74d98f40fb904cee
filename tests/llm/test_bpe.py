"""Byte-level BPE against the public library, and its round trip."""

import base64
import random

import numpy as np
import pytest
import public_tokenizers as P
import regex
import tiktoken

from rivulet.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_cutting_follows_the_pattern():
    pat = regex.compile(P.PATTERN)
    rng = random.Random(1)
    alphabet = "ab s t'  \n\t 12é!?.,'sld'rev m  ́😀² \x1c"
    for _ in range(5000):
        docs = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(rng.randint(1, 4))]
        words, ranks, counts = bpe._words(list(enumerate(docs)))
        w = words.to_pylist()
        assert [w[r].decode() for r in ranks] == [t for d in docs for t in pat.findall(d)]
        assert list(counts) == [len(pat.findall(d)) for d in docs]


@pytest.mark.parametrize("chunk", [50, 32_000_000])
def test_encode_and_decode(spark, monkeypatch, chunk):
    rows = [(1, "Hello world, it's 12 o'clock"), (2, None), (3, ""), (4, " \n\n x"), (5, "a" * 30_000), (6, " " * 9000),
            (1, "Hello world, it's 12 o'clock"), (None, "naïve 😀 text"), (8, "<|endoftext|>"), (9, "x'll y've 've")]
    df = spark.createDataFrame([(i, t, "c", "w") for i, t in rows], "doc_id bigint, text string, chunk string, ids string")
    got = bpe.decode(bpe.encode(df.repartition(3), PATH, chunk_chars=chunk), PATH).collect()
    enc = library()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    want = [(i, np.array(enc.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in rows]
    assert sorted(((r.doc_id, bytes(r.ids), bytes(r.bytes)) for r in got), key=key) == sorted(want, key=key)
    got = bpe.encode(df, PATH, chunk_chars=chunk, decoded=True).collect()
    assert sorted(((r.doc_id, bytes(r.ids), bytes(r.bytes)) for r in got), key=key) == sorted(want, key=key)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.decode(bpe.encode(df, PATH), PATH).collect() == []


def test_query_matches_the_library(spark):
    import hashlib
    from rivulet.llm.queries import QUERIES
    from tests.conftest import SF_SMALL
    enc = library()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect():
        ids = enc.encode_ordinary(t or "")
        want.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((t or "").encode())))
    got = QUERIES["op7_byte_bpe"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
