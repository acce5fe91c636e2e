"""Languages of texts: held-out accuracy, planted mixtures, and odd input."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF

from tallylake.llm import language, queries

EN = "the quick brown fox jumps over the lazy dog while all the children watch from their window"
DE = "der schnelle braune fuchs springt über den faulen hund und alle kinder schauen aus dem fenster"
FR = "le renard brun et rapide saute par dessus le chien paresseux pendant que les enfants regardent"


def _sentence(rng, words, count):
    return " ".join(rng.choice(words.split()) for _ in range(count))


def _labelled(spark):
    rng = random.Random(2)
    rows = [(lang, _sentence(rng, own, 40)) for lang, own in (("en", EN), ("de", DE), ("fr", FR)) for _ in range(30)]
    rows += [(None, "nothing"), ("en", None), ("en", ""), ("xx", "123")]
    return spark.createDataFrame(rows, "lang string, text string")


def _identify(spark, texts, **more):
    rows = [(i, t, "own") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    found = language.identify(docs, _labelled(spark), **more)
    assert found.columns == ["doc_id", "text", "lang_pred", "score", "languages"]
    return {r.doc_id: r for r in found.collect()}


def test_held_out_accuracy(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r.doc_id: r for r in documents.collect()}
    rows = queries.op13_language_id(spark, SF).collect()
    assert len(rows) == len(truth)
    right = []
    for row in rows:
        held_out = zlib.crc32(str(row.doc_id).encode()) % 3 == 1
        assert row.held_out == held_out and 0 <= row.score <= 1
        if held_out and truth[row.doc_id].lang is not None:
            right.append(row.lang_pred == truth[row.doc_id].lang)
    assert len(right) > 250 and np.mean(right) > 0.98


def test_mixtures_and_their_shares(spark):
    rng = random.Random(7)
    texts, shares = [], []
    for share in (1.0, 0.8, 0.65, 0.35, 0.2, 0.0):
        n = round(300 * share)
        texts.append(" ".join([_sentence(rng, EN, n), _sentence(rng, DE, 300 - n)]))
        shares.append(share)
    found = _identify(spark, texts)
    for i, share in enumerate(shares):
        own = {x["lang"]: x["share"] for x in found[i].languages}
        wanted = {k for k, v in (("en", share), ("de", 1 - share)) if v}
        assert set(own) == wanted
        assert own.get("en", 0) == pytest.approx(share, abs=0.05)
        assert found[i].lang_pred == ("en" if share > 0.5 else "de")
        assert found[i].score == pytest.approx(max(share, 1 - share), abs=0.05)


def test_texts_without_letters_and_odd_ones(spark):
    texts = [None, "", "123 456 !?", "²½ 10²", "THE LAZY DOG", "x", "the " * 400_000, "日本語", "a" * 1_000_000]
    found = _identify(spark, texts)
    for i in range(4):
        assert (found[i].lang_pred, found[i].score, found[i].languages) == ("und", 0.0, [])
    assert found[4].lang_pred == found[6].lang_pred == "en"
    assert all(found[i].lang_pred in ("en", "de", "fr") for i in (5, 7, 8))


def test_nothing_learned_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "the dog")], "doc_id long, text string")
    none = spark.createDataFrame([], "lang string, text string")
    row = language.identify(docs, none).first()
    assert (row.lang_pred, row.score) == ("und", 0.0)
    assert language.identify(docs.limit(0), _labelled(spark)).collect() == []


def test_text_alone_decides_and_repeats_stand(spark):
    docs = spark.createDataFrame(
        [(1, "the lazy dog", "de"), (1, "the lazy dog", None)], "doc_id long, text string, lang string"
    )
    rows = language.identify(docs, _labelled(spark)).collect()
    assert [r.lang_pred for r in rows] == ["en", "en"]
    assert rows[0].score == rows[1].score


def test_only_the_largest_languages_are_learned(spark):
    model = language.learn(_labelled(spark), "text", "lang", 2)
    assert len(model.languages) == 2


def test_counts_are_those_of_every_word(spark):
    words = language.words_of("The dog, the DOG; m² x_1")
    assert words == Counter({"the": 2, "dog": 2, "m": 1, "x": 1})
    feature, starts = language.trigrams(["ab", "c", "ab"])
    assert starts.tolist() == [0, 2, 3] and feature[:2].tolist() == feature[3:].tolist()
    # "ab" between blanks: " ab", "ab "; "c": " c ".
    assert feature[2] == language.trigrams(["c"])[0][0]


def test_set_is_the_best_of_all_by_likelihood():
    """The shares found are no less likely than those of a fine grid."""
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 50, size=(language.FEATURES, 2)).astype(float)
    model = language.Model(["a", "b"], counts)
    texts = [Counter({"".join(rng.choice(list("abcdef"), 4)): int(rng.integers(1, 5)) for _ in range(30)})]
    mixtures = language.Mixtures(model, texts)
    shares, likelihood = mixtures.fit(np.full((1, 2), 0.5), np.array([0]))
    grid = [
        float((mixtures.count * np.log(mixtures.likely @ np.array([p, 1 - p]))).sum())
        for p in np.linspace(0, 1, 201)
    ]
    assert likelihood[0] >= max(grid) - 0.05
    assert shares.sum() == pytest.approx(1.0)
