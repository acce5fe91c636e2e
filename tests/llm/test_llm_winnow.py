"""Winnowing: every shared span is found, and nothing else."""

from __future__ import annotations

import random

from tallylake.llm import winnow


def _words(text):
    import re

    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _slow(docs, items):
    wanted = {}
    for item, text in items:
        w = _words(text)
        n = min(10, len(w))
        for p in range(max(1, len(w) - 9) if w else 0):
            wanted.setdefault(tuple(w[p : p + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w = _words(text)
        hit, found = set(), set()
        for n in {len(g) for g in wanted}:
            for p in range(len(w) - n + 1):
                own = wanted.get(tuple(w[p : p + n]))
                if own:
                    hit.update(range(p, p + n))
                    found |= own
        out.append((doc, len(w), len(hit), tuple(sorted(str(i) for i in found if i is not None))))
    return sorted(out, key=str)


def _run(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, fp string")
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, span int")
    rows = winnow.shared_spans(d, b).collect()
    return sorted(
        ((r.doc_id, r.n_words, sum(s.stop - s.start for s in r.spans), tuple(r.items)) for r in rows),
        key=str,
    )


def test_random_texts_against_brute_force(spark):
    rng = random.Random(4)
    # Few words, so that grams repeat and ties are common.
    vocabulary = ["a", "b", "Cé", "dd"]
    text = lambda low, high: " ".join(rng.choice(vocabulary) for _ in range(rng.randint(low, high)))
    items = [(i, text(1, 30)) for i in range(25)] + [(100, ""), (101, None), (None, text(12, 14))]
    docs = [(i, text(0, 60)) for i in range(60)]
    docs += [(i, f"x{i} y {items[i % 25][1]}, z") for i in range(60, 90)]
    assert _run(spark, docs, items) == _slow(docs, items)


def test_long_distinct_words(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    items = [(i, " ".join(word() for _ in range(rng.randint(3, 40)))) for i in range(30)]
    docs = []
    for i in range(120):
        own = [word() for _ in range(rng.randint(0, 50))]
        w = _words(items[i % 30][1])
        size = rng.randint(1, len(w))
        at = rng.randint(0, len(w) - size)
        docs.append((i, " ".join(own + w[at : at + size] + own[::-1])))
    found = _run(spark, docs, items)
    assert found == _slow(docs, items)
    assert any(r[2] for r in found) and not all(r[2] for r in found)


def test_words_moved_across_the_gram_are_another_context(spark):
    a = "jgggj aeaeh gabcj djicf jhjbj aheid dhiih gcdci hcfba chdeg"
    b = "aeaeh gabcj djicf jhjbj aheid dhiih gcdci jgggj hcfba chdeg"
    docs, items = [(1, a), (2, b), (3, f"{b} {a}")], [(1, a), (2, b)]
    assert _run(spark, docs, items) == _slow(docs, items)


def test_rotations_against_brute_force(spark):
    """Items that are rotations of one another share grams in every context."""
    rng = random.Random(6)
    items, docs = [], []
    for n in range(12):
        words = [f"{rng.choice('abcdefg')}{i}" for i in range(rng.randint(10, 14))]
        for turn in range(len(words)):
            items.append((len(items), " ".join(words[turn:] + words[:turn])))
    for i in range(150):
        own = rng.choice(items)[1].split()
        at = rng.randint(0, 3)
        docs.append((i, " ".join(["x"] * at + own[at:] + rng.choice(items)[1].split()[: 10 + at])))
    assert _run(spark, docs, items) == _slow(docs, items)


def test_a_phrase_of_very_many_items_does_not_multiply(spark):
    """Every item and every document holds one phrase; pairs of them would be sixteen million."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    for phrase in ("answer the following question in a few", "answer the following question in a few short and simple words"):
        n_words = len(phrase.split())
        items = [(i, f"{word()} {phrase} {word()} {word()} {word()}") for i in range(4_000)]
        docs = [(i, f"{word()} {word()} {phrase} {word()}") for i in range(4_000)]
        d = spark.createDataFrame(docs, "doc_id long, text string")
        b = spark.createDataFrame(items, "item_id long, text string")
        found = winnow.shared_spans(d, b).selectExpr("size(items) as n", "size(spans) as s")
        wanted = (4_000, 1) if n_words >= 10 else (0, 0)
        assert [tuple(r) for r in found.distinct().collect()] == [wanted]


def test_odd_rows_and_empty_tables(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    docs = [(1, passage.upper()), (1, passage), (2, None), (2, ""), (None, passage + " w0" * 30_000)]
    items = [(7, passage), (7, passage), (8, passage), (9, None)]
    assert _run(spark, docs, items) == _slow(docs, items)
    assert _run(spark, docs, []) == _slow(docs, [])
    assert _run(spark, [], items) == []


def test_decontaminate_drops_hit_rows_only(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    rows = [(1, "x " + passage, "a"), (1, "clean", "b"), (None, passage, "c"), (3, None, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hits string")
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    assert sorted(r.hits for r in winnow.decontaminate(docs, items).collect()) == ["b", "d"]
