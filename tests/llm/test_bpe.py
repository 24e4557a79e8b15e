import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from repotide.llm import bpe as B

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    return B.Encoder(B.ranks_of(None, PATH), B.class_table())


@pytest.fixture(scope="module")
def library(encoder):
    ranks = {token: rank for rank, token in encoder.token.items()}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_equals_the_library_on_random_texts(encoder, library, monkeypatch):
    monkeypatch.setattr(B, "SCAN_CHARS", 200)
    monkeypatch.setattr(B, "BLOCK", 7)
    rng = random.Random(9)
    alphabet = ["'", "s", "t", "re", "ve", "l", "m", "D", "d", " ", "  ", "\n", "\t", " ", "1", "²", "é", "ß", "!", "😀", "_", "　", "aaaa"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    texts += ["'", "''s", " 's", "\n's", "x's's", "'re", "'r", "'l", "'", "l", "e's"]
    for text, (ids, at, counts) in zip(texts, encoder(texts), strict=True):
        assert ids == library.encode_ordinary(text), repr(text)
        assert encoder.decode(ids) == text.encode()
        assert sum(counts) == len(ids) and len(at) == len(counts)


def test_documents(spark, documents, clashing, odd, library):
    texts = [*odd, "It's naïve, isn't it?  Yes\n\n  we'll see 123 ABC's."]
    for r in B.digests(clashing(documents(texts)), PATH).collect():
        ids = library.encode_ordinary(texts[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()
    rows = B.encoded(documents(texts), PATH)
    back = {r["doc_id"]: bytes(r["bytes"]).decode() for r in B.decoded(rows, PATH).collect()}
    assert back == {k: t or "" for k, t in enumerate(texts)}
    assert B.digests(documents(texts).limit(0), PATH).count() == 0
