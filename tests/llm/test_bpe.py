import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from barsmith.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(PATH, public_tokenizers.PATTERN)


def ids(codec, text):
    return np.frombuffer(codec.encode(text), "<u4").tolist()


def test_ids_match_the_library(codec, library):
    rng = random.Random(3)
    bits = ["a", "b", " ", "\n", "é", "ñ", "1", "'s", "'", "日本", "𝒳", " ", "\x1c", "\x85", " the", "ing", "\t", "!", "..", "ß", "🙂"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 60)))
        assert ids(codec, text) == library.encode_ordinary(text)


@pytest.mark.parametrize("alphabet", ["a", "ab", "etaoinshr", "éñüß", "ha"])
def test_long_pieces_pass_through_the_queue(codec, library, alphabet):
    rng = random.Random(len(alphabet))
    text = "".join(rng.choice(alphabet) for _ in range(3 * bpe.QUEUE + 17))
    assert ids(codec, text) == library.encode_ordinary(text)


def test_every_token_and_pairs_of_tokens(codec):
    rng = random.Random(4)
    tokens = sorted(codec.merges.bytes_of)
    for _ in range(20000):
        a, b = rng.choice(tokens), rng.choice(tokens[:3000])
        assert codec.merges.apart(a, b) == (codec.merges.merge(codec.merges.bytes_of[a] + codec.merges.bytes_of[b]) == [a, b])


def test_streaming_decode_at_every_cut():
    data = "a é 日本 🙂 z".encode() + b"\xff\xe2\x82" + b"ok\xf0\x9f"
    for step in range(1, len(data)):
        s = bpe.Utf8Stream()
        text = "".join(s.feed(data[i:i + step]) for i in range(0, len(data), step)) + s.finish()
        assert text == data.decode("utf-8", "replace")
        assert s.bad == text.count("�")


def test_documents(spark, library):
    texts = ["Hello  world", "", None, "é" * 5000, "x " * 30000, "Hello  world"]
    docs = spark.createDataFrame([(i, t, b"x") for i, t in enumerate(texts)], "doc_id long, text string, ids binary")
    got = {r.doc_id: r for r in bpe.encode_documents(docs, PATH, public_tokenizers.PATTERN).collect()}
    for i, t in enumerate(texts):
        raw = np.array(library.encode_ordinary(t or ""), "<u4").tobytes()
        assert got[i].n_tokens == len(raw) // 4 and bytes(got[i].ids) == raw and got[i].n_replaced == 0
        assert got[i].ids_sha256 == hashlib.sha256(raw).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.encode_documents(docs.filter("doc_id < 0"), PATH, public_tokenizers.PATTERN).count() == 0
