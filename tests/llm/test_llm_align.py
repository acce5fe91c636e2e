"""Token alignment against the tokenizers themselves and a plain walk over their bytes."""

from __future__ import annotations

import hashlib
import os
import random
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
from conftest import SMALL

from tallylake.llm import align, queries

JSON, MODEL = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def encoders():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(JSON)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=MODEL)


def _byte_table() -> dict[str, int]:
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


def _tokens(encoders, text):
    """[(id, bytes)] of both sides, or nothing."""
    a, b = encoders
    table, whole = _byte_table(), (" " + (text or "")).encode()
    if not text:
        return [], []
    left = [
        (i, bytes(table[c] for c in a.id_to_token(i)))
        for i in a.encode(" " + text, add_special_tokens=False).ids
    ]
    right = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        own = bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()
        right.append((i, own))
    if any(b"".join(t for _, t in side) != whole for side in (left, right)):
        return [], []
    return left, right


def _spans(tokens):
    spans, at = [], 0
    for i, own in tokens:
        spans.append((i, at, at + len(own)))
        at += len(own)
    return spans


def _brute(encoders, texts):
    found, counts = [], Counter()
    for text in texts:
        a, b = (_spans(side) for side in _tokens(encoders, text))
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        counts.update(links)
        ends, groups, start = {x[2] for x in a} & {y[2] for y in b}, [], 0
        for end in sorted(ends):
            sides = [[str(x[0]) for x in s if start <= x[1] and x[2] <= end] for s in (a, b)]
            groups.append("|".join(",".join(s) for s in sides))
            start = end
        found.append((len(a), len(b), links, groups))
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [
        {
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": len(groups),
            "n_links": len(links),
            "n_best": sum(counts[x] == most[x[1]] for x in links),
            "count_sum": sum(counts[x] for x in links),
            "groups": ";".join(groups),
        }
        for n_a, n_b, links, groups in found
    ]


def _texts():
    rng = random.Random(5)
    pool = ["a", " ", "  ", "\n", "\t", "the", " the", "ing", "é", " straße", "日本", "😀", "'s", "12",
            " 345", "###", "<|endoftext|>", "</s>", "<0x41>", "Zürich", " naïve", "ab" * 9, " ",
            "\x00", "́", "ﬁ"]
    mixed = ["".join(rng.choice(pool) for _ in range(rng.randint(1, 25))) for _ in range(150)]
    return [None, "", " ", "\n", "▁", "a▁b", "same text here", "same text here", *mixed]


def test_alignment_equals_brute_force(spark, encoders):
    texts = _texts()
    docs = spark.createDataFrame(
        [(i, t, "own") for i, t in enumerate(texts)], "doc_id long, text string, groups string"
    )
    # Small blocks: the counts of the corpus meet blocks other than those they come from.
    found = align.align(docs, JSON, MODEL, P.PATTERN, block_bytes=300, outputs=tuple(align.OUTPUTS))
    assert found.columns == ["doc_id", "text", *align.OUTPUTS]
    wanted = _brute(encoders, texts)
    rows = found.collect()
    assert len(rows) == len(texts)
    for row in rows:
        own = wanted[row.doc_id]
        assert {k: row[k] for k in own} == own, texts[row.doc_id]
        digest = hashlib.sha256(own["groups"].encode()).hexdigest() if own["groups"] else ""
        assert row.groups_sha256 == digest
    assert sum(w["n_a"] == 0 for w in wanted) >= 4


def test_every_token_and_character_encodes_as_in_the_file(encoders):
    own = align.Tokenizers(open(JSON, "rb").read(), open(MODEL, "rb").read(), P.PATTERN)
    texts = [t.decode() for t in own.bytes[0] if t and t.decode(errors="ignore").encode() == t]
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts += [f"a{chr(c)}b 1{chr(c)}2 {chr(c)}  {chr(c)}!" for c in points[::7]]
    for i in range(0, len(texts), 20_000):
        part = texts[i : i + 20_000]
        for text, whole in zip(part, encoders[0].encode_batch_fast(part, add_special_tokens=False)):
            assert own.encode_a(text).tolist() == whole.ids


def test_very_long_texts_end(spark, encoders):
    texts = ["a" * 300_000, " " * 1_000_000, "\n" * 1_000_000, "word " * 60_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in align.align(docs, JSON, MODEL, P.PATTERN, keep=["doc_id"]).collect()}
    for i, text in enumerate(texts):
        a, b = _tokens(encoders, text)
        assert (rows[i].n_a, rows[i].n_b) == (len(a), len(b))


def test_empty_and_nulls(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert align.align(docs, JSON, MODEL, P.PATTERN).collect() == []
    docs = spark.createDataFrame([(None, None), (None, "one text"), (None, "one text")], docs.schema)
    rows = align.align(docs, JSON, MODEL, P.PATTERN, keep=["doc_id"]).collect()
    assert sorted(r.n_a for r in rows) == [0, 2, 2]
    # Both texts count: every link stands twice in the corpus.
    assert sorted(r.count_sum for r in rows) == [0, 4, 4]


def test_another_kind_of_file_is_refused():
    with pytest.raises(ValueError):
        align.byte_level_ranks(open(P.path("word_bpe_49k.json")).read())


def test_query(spark, encoders):
    texts = dict(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    # The plain walk compares every pair of tokens, so its texts are short; the query's are not cut.
    rows = {r.doc_id: r for r in queries.op11_token_alignment(spark, SMALL).collect()}
    assert rows.keys() == texts.keys()
    for doc_id, text in texts.items():
        a, b = _tokens(encoders, text)
        assert (rows[doc_id].n_a, rows[doc_id].n_b) == (len(a), len(b))
        if len(text) < 400:
            own = _brute(encoders, [text])[0]
            assert rows[doc_id].n_groups == own["n_groups"]
            assert rows[doc_id].n_links == own["n_links"]
            assert rows[doc_id].groups_sha256 == hashlib.sha256(own["groups"].encode()).hexdigest()
