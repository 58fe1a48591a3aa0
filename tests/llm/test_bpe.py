import base64
import random
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from ratingloom.llm import bpe

FILE, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
PARTS = [" ", "  ", "\n", "\t", "a", "aa", "the", "The", "'s", "'ll", "1", "22", "é", "中", "\xa0", "\x1c", "\x85", "!", "🙂", "́", "\0"]


@pytest.fixture(scope="module")
def own():
    with open(FILE, "rb") as opened:
        return bpe.Vocabulary(opened.read(), PATTERN)


@pytest.fixture(scope="module")
def other(own):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=own.ranks, special_tokens={})


def ids(own, text):
    return np.frombuffer(own.encode(text), "<u4").tolist()


def test_like_the_library(own, other):
    choose = random.Random(1)
    texts = ["".join(choose.choices(PARTS, k=choose.randint(0, 25))) for _ in range(5000)]
    texts += ["a" * 3001, "ab" * 1000, "".join(choose.choices("abcdefghij", k=3000)), " " * 500 + "x"]
    for text in texts:
        assert ids(own, text) == other.encode_ordinary(text)


def test_very_long_pre_token(own):
    text = "".join(random.Random(2).choices("abcdefghij", k=200_000))
    assert own.decode(ids(own, text)).decode() == text


def test_query(spark, other):
    texts = {None: "null id", 1: None, 2: "", 3: "Étion dans <|endoftext|>", 4: "word " * 30000, 5: "x" * 30000}
    rows = [(i, t, -1) for i, t in texts.items()] + [(3, texts[3], -1)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    found = bpe.round_trip(documents, FILE, PATTERN).collect()
    assert len(found) == 7
    decoded = bpe.decode(bpe.encode(documents, FILE, PATTERN), FILE, PATTERN).collect()
    assert sorted((row.doc_id or -1, sha256(row.bytes).hexdigest(), len(row.ids)) for row in decoded) == sorted(
        (row.doc_id or -1, row.decoded_sha256, row.n_tokens) for row in found
    )
    for row in found:
        text = texts[row.doc_id] or ""
        expected = other.encode_ordinary(text)
        assert row.n_tokens == len(expected)
        assert row.ids_sha256 == sha256(np.array(expected, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == sha256(text.encode()).hexdigest()


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.round_trip(none, FILE, PATTERN).collect() == []
    assert bpe.decode(bpe.encode(none, FILE, PATTERN), FILE, PATTERN).collect() == []


def test_vocabulary_is_read(own):
    with open(FILE, "rb") as opened:
        token, rank = opened.readline().split()
    assert own.ranks[base64.b64decode(token)] == int(rank)


def test_what_is_kept_is_bounded(own, other, monkeypatch):
    with open(FILE, "rb") as opened:
        words = bpe.Vocabulary(opened.read(), PATTERN)
    monkeypatch.setattr(bpe, "KEPT_BYTES", 40_000)
    for k in range(60):
        text = " ".join(f"w{k}x{i},{i}" for i in range(20))
        assert ids(words, text) == other.encode_ordinary(text)
        assert len(words.kept) + len(words.before) + len(words.parts) < 600


def test_unknown_ids_raise(own):
    gap = bpe.Vocabulary(b"YQ== 0\nYg== 2\n", PATTERN)
    assert gap.decode([0, 2]) == b"ab"
    for unknown in ([1], [3], [-1]):
        with pytest.raises(ValueError):
            gap.decode(unknown)
