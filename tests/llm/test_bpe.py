import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm_cases import awkward, collected, frame

from quadrille.llm import bpe

FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(FILE)


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=ranks,
        special_tokens={},
    )


def test_ids_equal_the_library(ranks, reference):
    r = random.Random(1)
    alphabet = " \n\t\x1c\x85　  aab'stré日本🙂12,.!<|endoftext|>"
    texts = ["".join(r.choices(alphabet, k=r.randint(0, 80))) for _ in range(3000)]
    texts += ["", " ", "a  b", "a   b c", "x" * 3000, "ab" * 900, "日" * 700, " " * 1500]
    codec = bpe.ByteBpe(ranks, public_tokenizers.PATTERN)
    for _ in range(2):  # the second time from memory
        ids, counts = codec.encode(texts)
        for text, part in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
            assert part.tolist() == reference.encode_ordinary(text)
            assert codec.decode(part) == text.encode()


def test_memory_starts_anew(ranks, reference, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 10)
    codec = bpe.ByteBpe(ranks, public_tokenizers.PATTERN)
    for text in ("one two three " * 9, "four five six seven eight nine ten", "one two"):
        ids, _ = codec.encode([text] * 3)
        assert ids.tolist() == reference.encode_ordinary(text) * 3


def test_documents(spark, reference):
    rows = awkward()
    out = bpe.encode_documents(
        frame(spark, rows), FILE, public_tokenizers.PATTERN, keep_ids=True
    )
    expected = []
    for i, text in rows:
        ids = reference.encode_ordinary(text or "")
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        plain = hashlib.sha256((text or "").encode()).hexdigest()
        expected.append((i, len(ids), digest, plain, ids))
    found = collected(out, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids")
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
    decoded = bpe.decode_tokens(out, FILE)
    assert sorted(collected(decoded, "bytes")) == sorted(
        ((t or "").encode(),) for _, t in rows
    )


def test_decoding_of_bad_ids(spark):
    df = spark.createDataFrame(
        [(1, None), (2, [10**6]), (3, []), (4, [None])], "doc_id long, ids array<int>"
    )
    out = dict(collected(bpe.decode_tokens(df, FILE), "doc_id", "bytes"))
    assert out == {1: None, 2: None, 3: b"", 4: None}


def test_empty_table(spark):
    out = bpe.encode_documents(frame(spark, []), FILE, public_tokenizers.PATTERN)
    assert out.count() == 0
