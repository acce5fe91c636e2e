"""SimHash near-duplicates against brute force."""

from __future__ import annotations

import re

import numpy as np
import xxhash

from tallylake.llm import simhash


def _slow_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(
        1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)
    )


def _slow_components(fps, max_bits=3):
    label = list(range(len(fps)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def _clusters(rng, centres, size, steps):
    """Fingerprints that wander off from their centres by single bits."""
    out = []
    for _ in range(centres):
        fp = int(rng.integers(0, 2**63)) * 2 + int(rng.integers(0, 2))
        for _ in range(size):
            out.append(fp)
            for _ in range(int(rng.integers(1, steps + 1))):
                fp ^= 1 << int(rng.integers(0, 64))
    return out


def test_fingerprint_is_the_plain_definition():
    for text in (None, "", " \n", "One", "one two", "A b\tC d\x0be", "É é\x85x y z w", "w " * 700):
        assert simhash.fingerprint(text) == _slow_fingerprint(text)


def test_long_texts_are_cut_without_a_change(monkeypatch):
    text = " ".join(f"w{i * i % 97}" for i in range(200))
    whole = simhash.fingerprint(text)
    for size in (1, 7, 198):
        monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", size)
        assert simhash.fingerprint(text) == whole


def test_links_connect_all_within_the_budget(spark):
    rng = np.random.default_rng(3)
    fps = sorted(set(_clusters(rng, 12, 40, 4) + [0, 2**64 - 1, 7, 2**63]))
    plain = _slow_components(fps)
    frame = spark.createDataFrame([(np.uint64(f).astype(np.int64).item(),) for f in fps], "fp bigint")
    # Small limits cut units again and again.
    for unit_rows in (50_000, 5):
        edges = simhash.links(frame, unit_rows=unit_rows)
        pairs = [(r.a % 2**64, r.b % 2**64) for r in edges.collect()]
        place = {f: i for i, f in enumerate(fps)}
        label = list(range(len(fps)))

        def root(x):
            while label[x] != x:
                x = label[x]
            return x

        for a, b in pairs:
            x, y = root(place[a]), root(place[b])
            label[max(x, y)] = min(x, y)
        assert [root(i) for i in range(len(fps))] == plain


def test_dense_cluster_gives_a_forest_not_all_pairs():
    base = 0x0123456789ABCDEF
    key = np.array(sorted({base ^ (1 << i) ^ (1 << j) for i in range(48) for j in range(i)}), np.uint64)
    n = len(key)
    same = np.zeros(n, np.int64)
    x, y = simhash.trie_links(same, same, same, same + 4, key, 4)
    assert n == 1128 and len(x) == n - 1


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101)], "a long, b long")
    found = dict(simhash.components(edges).collect())
    assert found == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


def test_operator_on_odd_rows(spark):
    copy = "the quick brown fox jumps over the lazy dog again and again"
    rows = [(5, copy), (3, copy), (9, None), (8, ""), (None, copy), (3, copy), (7, "other words")]
    rows = [(i, t, "kept", "x") for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id string")
    found = simhash.near_duplicates(docs)
    by = sorted((r.doc_id or -1, r.component_id) for r in found.collect())
    assert by == [(-1, 3), (3, 3), (3, 3), (5, 3), (7, 7), (8, 8), (9, 8)]
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 7, 8]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.keep_first(docs.limit(0)).count() == 0
