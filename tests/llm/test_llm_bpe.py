"""BPE against the tiktoken library, and back again."""

from __future__ import annotations

import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from tallylake.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoding():
    lines = open(PATH, "rb").read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _texts():
    rng = random.Random(1)
    pool = ["a", "aa", "aaa", " ", "  ", "\n", "\t", "the", "ing", "\x1c", "\x85", "é", "日本", "😀",
            "'s", "'LL", "123", "###", "x" * 50, "ab" * 30, "​", "\r\n", "ſ", "٣", "́",
            "<|endoftext|>", "a" * 999]
    mixed = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    letters = ["".join(rng.choice("aeinorst") for _ in range(rng.randint(1, 300))) for _ in range(200)]
    return mixed + letters + [None, "", "word " * 50_000, "z" * 100_000]


def test_ids_are_the_library_s_and_decode_back(spark, encoding):
    texts = _texts()
    rows = [(i, t, "own") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    # Small slices: pieces are remembered and replayed over many of them.
    found = bpe.tokenize(docs, PATH, P.PATTERN, outputs=tuple(bpe.OUTPUTS), slice_bytes=3000)
    assert found.columns == ["doc_id", "text", *bpe.OUTPUTS]
    for row in found.collect():
        text = texts[row.doc_id] or ""
        ids = encoding.encode_ordinary(text)
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert row.token_ids == ids and row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(packed).hexdigest()
        assert bytes(row.decoded) == text.encode()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_memory_of_pieces_is_bounded(monkeypatch, encoding):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    vocabulary, known = bpe.Vocabulary(bpe.read_ranks(PATH)), {}
    for text in ["one two", "three four five six", "one seven"]:
        ids = bpe.encode_texts([text], vocabulary, P.PATTERN, known)[0]
        assert vocabulary.decode(ids) == text.encode()
        assert len(ids) // 4 == len(encoding.encode_ordinary(text))
    assert len(known) <= 3


def test_a_lower_rank_that_arises_late():
    """Ranks out of the usual order: the replay must agree with the plain rule."""
    tokens = [bytes([b]) for b in range(256)] + [b"abcd", b"bc", b"ab", b"bcd", b"cd", b"aab", b"ca"]
    file = b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens))
    vocabulary = bpe.Vocabulary(file)
    rng = random.Random(2)
    words = [bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, 25))) for _ in range(3000)]
    plain = [b"".join(i.to_bytes(4, "little") for i in vocabulary.encode_word(w)) for w in words]
    whole = [vocabulary.ranks.get(w) for w in words]
    plain = [p if r is None else r.to_bytes(4, "little") for p, r in zip(plain, whole)]
    assert vocabulary.encode_words(words) == plain


def test_empty_table_and_unknown_output(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.tokenize(docs, PATH, P.PATTERN).count() == 0
    with pytest.raises(ValueError):
        bpe.tokenize(docs, PATH, P.PATTERN, outputs=("nothing",))


def test_a_word_by_itself(encoding):
    """The way of words in which a lower rank arises late: the library's ids, in n log n steps."""
    vocabulary = bpe.Vocabulary(open(PATH, "rb").read())
    whole = tiktoken.Encoding(
        "whole", pat_str=r"(?s).+", mergeable_ranks=vocabulary.ranks, special_tokens={}
    )
    rng = random.Random(2)
    words = ["".join(rng.choice("aeinorsthé 0") for _ in range(rng.randint(1, 60))) for _ in range(500)]
    for word in [*words, "ab" * 30_000, "a" * 30_000]:
        assert vocabulary.encode_word(word.encode()) == whole.encode_ordinary(word)
