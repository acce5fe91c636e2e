"""Hard negatives against every product."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallylake.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def _plain(rows, is_anchor):
    """The definition, row by row; rows are told apart by their place."""
    own = []
    for vec_id, x, label in rows:
        if vec_id is None or label is None or x is None:
            continue
        if any(v is None or not math.isfinite(v) for v in x):
            continue
        own.append((vec_id, label, [math.floor(256 * float(np.float32(v))) for v in x]))
    found = []
    for a, (anchor, label, x) in enumerate(own):
        if not is_anchor(anchor):
            continue
        scored = [
            (-sum(p * q for p, q in zip(x, y)), other, same == label)
            for b, (other, same, y) in enumerate(own)
            if b != a
        ]
        scored.sort()
        for score, positive, _ in [s for s in scored if s[2]][:5]:
            p = -score
            fit = [s for s in scored if not s[2] and 50 * p <= -100 * s[0] <= 95 * p]
            for rank, (n, negative, _) in enumerate(fit[:3], 1):
                found.append((anchor, positive, rank, negative, p, -n))
    return sorted(found)


def _found(spark, rows, every=5, **more):
    df = spark.createDataFrame(rows, SCHEMA)
    found = hn.hard_negatives(df, F.col("vec_id") % every == 0, **more)
    assert found.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    ]
    return sorted(tuple(r) for r in found.collect())


def _random_rows(seed, count=400, width=12, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, width))
    label = rng.integers(0, labels, count)
    x = centres[label] + rng.normal(size=(count, width))
    # Lengths over several buckets.
    x *= rng.choice([0.01, 0.3, 1.0, 7.0], size=(count, 1))
    return [(i, [float(np.float32(v)) for v in r], int(n)) for i, (r, n) in enumerate(zip(x, label))]


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("block_rows", [37, 100_000])
def test_equals_all_products(spark, monkeypatch, seed, block_rows):
    monkeypatch.setattr(hn, "BUCKET_ROWS", 16)
    rows = _random_rows(seed)
    assert _found(spark, rows, block_rows=block_rows) == _plain(rows, lambda i: i % 5 == 0)


def test_ties_copies_and_zero_vectors(spark):
    rng = random.Random(4)
    rows = [(i, [1.0, 0.0, 0.5], i % 3) for i in range(60)]
    rows += [(100 + i, [0.0, 0.0, 0.0], i % 2) for i in range(10)]
    rows += [(200 + i, [-1.0, 0.2, 0.0], 1) for i in range(10)]
    rows += [(300 + i, [0.6, 0.1, 0.4], 2) for i in range(10)]
    rng.shuffle(rows)
    assert _found(spark, rows, block_rows=17) == _plain(rows, lambda i: i % 5 == 0)


def test_a_repeated_row_is_another_row(spark):
    rows = [(0, [1.0, 1.0], 1), (0, [1.0, 1.0], 1), (1, [0.8, 0.9], 2), (2, [0.5, 0.6], 2)]
    assert _found(spark, rows) == _plain(rows, lambda i: i % 5 == 0)
    assert len(_found(spark, rows)) == 4


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (None, [1.0, 0.0], 1),
        (5, None, 1),
        (10, [1.0, None], 1),
        (15, [nan, 0.0], 1),
        (20, [inf, 0.0], 1),
        (25, [1.0, 0.0], None),
        (30, [1.0, 0.0], 1),
        (31, [0.9, 0.1], 1),
        (32, [0.7, 0.1], 2),
        (33, [0.6], 2),
        (34, [3e38, 3e38], 2),
        (35, [], 3),
    ]
    kept = [r for r in rows if r[0] != 34]
    kept = [(i, x + [0.0] * (2 - len(x)) if x is not None else x, n) for i, x, n in kept]
    found = _found(spark, rows)
    assert found == _plain(kept, lambda i: i % 5 == 0) and found


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(9)
    rows = [
        (i, [float(np.float32(v)) for v in rng.normal(size=4) * 10.0 ** (i % 7)], i % 3)
        for i in range(120)
    ]
    assert _found(spark, rows) == _plain(rows, lambda i: i % 5 == 0)


def test_empty_and_lonely(spark):
    assert _found(spark, []) == []
    assert _found(spark, [(0, [1.0], 1)]) == []
    assert _found(spark, [(0, [1.0], 1), (1, [1.0], 2)]) == []


def test_pruning_leaves_rows_out(spark):
    """A threshold of a close row rules most of a bucket out before any product."""
    rng = np.random.default_rng(3)
    vectors = np.floor(256 * rng.normal(size=(2000, 8))).astype(np.int64)
    ids = np.arange(2000)
    block = hn.Block(ids, ids, ids % 2, vectors)
    bucket = block.buckets(None)[0]
    unit = vectors[0] / np.linalg.norm(vectors[0])
    focus = np.argsort(-np.abs(unit))[: hn.FOCUS]
    few = bucket.candidates(unit, focus, 0.9)
    assert few is not None and len(few) < len(bucket.rows) / 4
    cosines = bucket.unit @ unit
    assert set(np.flatnonzero(cosines >= 0.9)) <= set(few.tolist())
