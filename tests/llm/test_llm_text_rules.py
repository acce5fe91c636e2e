"""Quality rules, licence scan and surrogates on small tables."""

from __future__ import annotations

import re

from tallylake.llm import licenses, pii, quality


def _docs(spark, rows, extra="kept"):
    return spark.createDataFrame(
        [(i, t, s, "x") for i, t, s in rows], f"doc_id long, text string, source string, {extra} string"
    )


def _prose(n, start=0):
    return " ".join(f"w{start + i}x" for i in range(n))


# --- quality --------------------------------------------------------------------------


def test_base_counts(spark):
    gram = _prose(8)
    rows = [
        (1, f"{gram} {gram} " + _prose(40, 50), "s"),
        (2, None, "s"),
        (3, " \t\n ", None),
        (4, "a #1 $\n\nsame line\nsame line\n same line\nsame line", "s"),
        (5, "same " * 30, "s"),
        (6, _prose(30_000), "s"),
        (6, "é\x85日本 x", "s"),
    ]
    found = {(r.doc_id, r.n_words): r for r in quality.quality_rules(_docs(spark, rows)).collect()}
    pick = lambda i, n: tuple(found[i, n][c] for c in quality.METRICS[1:])
    assert pick(1, 56) == (len(gram.replace(" ", "")) * 2 + 40 * 4, 0, 0, 16)
    assert pick(2, 0) == pick(3, 0) == (0, 0, 0, 0)
    assert pick(4, 11)[1:3] == (2, 2) and pick(5, 30)[3] == 30
    assert pick(6, 30_000)[3] == 0 and pick(6, 2)[0] == 5
    assert {k for k, r in found.items() if r.base_failed} == {(2, 0), (3, 0), (4, 11), (5, 30), (6, 2)}
    assert all(r.kept != r.base_failed for r in found.values())


def test_common_lines_deplete(spark):
    common = "Read 123 more about our offers here today and then subscribe to the letter"
    rows = [(i, f"{_prose(8, 100 * i)}\n{common.replace('123', str(i))}\n{common}", "a") for i in range(30)]
    rows += [(100 + i, f"{_prose(60, 100 * i)}\n{common}", "a") for i in range(10)]
    # Copies count once; another host does not see the line often enough.
    rows += [(200 + i, f"{_prose(30, 9000)}\nalone here", "a") for i in range(40)]
    rows += [(300, f"{_prose(10, 1)}\n{common}", "b"), (301, f"{_prose(30, 5)}\n{common}", None)]
    docs = _docs(spark, rows, "removed")
    found = {r.doc_id: r for r in quality.quality_rules(docs).collect()}
    assert [i for i, r in sorted(found.items()) if not r.kept] == list(range(30))
    assert found[100].n_boilerplate_words == 14 and found[200].n_boilerplate_words == 0
    good = {r.doc_id: r for r in quality.keep_good(docs).collect()}
    assert sorted(good) == sorted(set(found) - set(range(30)))
    assert good[105].text == _prose(60, 500) and good[300].text == rows[-2][1]
    assert quality.keep_good(docs).columns == docs.columns
    empty = docs.limit(0)
    assert quality.quality_rules(empty).count() == quality.keep_good(empty).count() == 0


def test_length_follows_and_rows_repeat(spark):
    docs = spark.createDataFrame(
        [(1, _prose(30), "s", 7), (1, _prose(30), "s", 7), (None, _prose(30, 3), None, None)],
        "doc_id long, text string, source string, n_chars int",
    )
    kept = quality.keep_good(docs)
    assert kept.schema == docs.schema
    assert sorted((r.doc_id or 0, r.n_chars or 0) for r in kept.collect()) == [(0, 0), (1, 7), (1, 7)]


# --- licences -------------------------------------------------------------------------


def _units(text):
    """Lines, blocks, the whole text, and one to three sentences of a block, each once."""
    blocks = re.split(r"\n[\x20\t\x0b-\r]*\n", text)
    units = text.split("\n") + [b for b in blocks if "\n" in b]
    if len(blocks) > 1:
        units.append(text)
    for block in blocks:
        parts, start = [], 0
        for m in re.finditer(r"\s+", block):
            before, after = block[: m.start()], block[m.end() :]
            if before[-1:] in (".", "!", "?") and (after[:1].isupper() or after[:1] in tuple("\"'(#*/")):
                parts.append(block[start : m.start()])
                start = m.end()
        parts.append(block[start:])
        for size in (1, 2, 3):
            if size < len(parts):
                units += [" ".join(parts[i : i + size]) for i in range(len(parts) - size + 1)]
    return units


def _slow_licenses(text):
    names = set()
    for unit in _units(text or ""):
        own = licenses.bigrams(licenses.template_words(unit))
        scores = []
        for name, template in licenses.TEMPLATES:
            other = licenses.bigrams(licenses.template_words(template))
            if own and 10 * len(own & other) >= 4 * (len(own) + len(other)):
                scores.append((2 * len(own & other) / (len(own) + len(other)), name))
        names |= {name for score, name in scores if score == max(scores)[0]}
    return sorted(names)


def test_licence_probes(spark):
    gpl = next(t for n, t in licenses.TEMPLATES if n == "GPL-3.0" and t.startswith("This program"))
    words = gpl.split()
    wrapped = "\n".join("# " + " ".join(words[i : i + 10]) for i in range(0, len(words), 10))
    mit = max((t for n, t in licenses.TEMPLATES if n == "MIT"), key=len)
    texts = {
        "This work is licensed under the GNU General Public License, version 3.": ["GPL-3.0"],
        "Released under the MIT License. See the file LICENSE for details.": ["MIT"],
        "About this file. Released under the MIT License. Have fun!": ["MIT"],
        gpl: ["GPL-3.0"],
        f"{wrapped}\n# See the file COPYING for the text.": ["GPL-3.0"],
        mit.replace(". ", ".\n\n").replace("conditions: ", "conditions:\n\n"): ["MIT"],
        "We licensed the software under a contract. It is released to the public.": [],
    }
    docs = _docs(spark, [(i, t, "s") for i, t in enumerate(texts)])
    found = {r.doc_id: r.licenses for r in licenses.find_licenses(docs).collect()}
    assert found == dict(enumerate(texts.values()))


def test_a_long_text_of_licences(spark):
    """Sentences, lines and blocks of one text of a megabyte."""
    line = "Released under the MIT License. See LICENSE.\n"
    docs = _docs(spark, [(1, line * 8_000, "s"), (2, "licensed under. " * 20_000, "s"), (3, "." * 500_000, "s")])
    found = {r.doc_id: r for r in licenses.find_licenses(docs).collect()}
    assert found[1].licenses == ["MIT"] and len(found[1].matches) >= 8_000
    assert found[2].licenses == found[3].licenses == []


def test_licenses_against_brute_force(spark):
    mit = licenses.TEMPLATES[3][1]
    texts = [t for _, t in licenses.TEMPLATES] + [
        None, "", "word", "All rights reserved", "all RIGHTS, reserved!\nno licence",
        mit.replace(", ", ",\n"), "intro\n\n" + mit.replace("Software", "Work").replace(". ", ".\n"),
        mit + " and " + _prose(40), "Licensed under the MIT Licence", _prose(40_000),
        "Released under the MIT License. Released under the MIT License.",
        "x\n" * 500 + "Licensed under CC BY-NC 4.0.",
    ]
    docs = _docs(spark, [(i, t, "s") for i, t in enumerate(texts)], "licenses")
    found = {r.doc_id: r.licenses for r in licenses.find_licenses(docs).collect()}
    assert found == {i: _slow_licenses(t) for i, t in enumerate(texts)}
    assert found[3] == ["MIT"] and found[len(texts) - 1] == ["CC-BY-NC-4.0"]
    assert licenses.find_licenses(docs.limit(0)).count() == 0


def test_anchors_cannot_be_missed():
    for _, text in licenses.TEMPLATES:
        own = licenses.bigrams(licenses.template_words(text))
        low, high = licenses.size_bounds(len(own), licenses.THRESHOLD)
        assert len(own) - len(licenses.anchors(own, licenses.THRESHOLD)) < low
        assert 2 * len(own) * 5 >= 4 * (len(own) + high) and 2 * low * 5 >= 4 * (len(own) + low)


# --- surrogates -----------------------------------------------------------------------

LETTER = (
    "Dear Mrs. Anna Berg, write to Anna.Berg@mail.example.com or +1 (212) 555-0199. "
    "Card 4111-1111-1111-1111 or 4111 1111 1111 1111, DE89 3704 0044 0532 0130 00, 10.1.2.3."
)


def _kinds(row):
    return [e.kind for e in row.entities]


def test_surrogates_keep_format_gender_and_coreference(spark):
    rows = [
        (1, LETTER, "s"),
        (2, "anna.berg@MAIL.example.com met Mr. Anna Berg and Dr. Иван Петров", "s"),
        (2, None, "s"),
        (None, "", "s"),
        (4, "nothing here, 3.14 and 2024-01-01 are no entities", "s"),
        (5, "x " * 50_000 + "10.1.2.3", "s"),
    ]
    docs = _docs(spark, rows, "entities")
    found = {(r.doc_id, (r.text or "")[:1]): r for r in pii.surrogates(docs, "k").collect()}
    one = found[1, "D"]
    assert _kinds(one) == ["name", "email", "phone", "card", "card", "iban", "ip"]
    for e in one.entities:
        original = LETTER[e.start : e.end]
        assert e.surrogate != original and original not in one.text and e.surrogate in one.text
        if e.kind in ("phone", "card", "iban"):
            shape = lambda s: re.sub("[A-Z]", "A", re.sub("[0-9]", "0", s))
            assert shape(e.surrogate) == shape(original)
    # Both spellings of the card, and both of the address, are one entity.
    cards = [re.sub(r"\D", "", e.surrogate) for e in one.entities if e.kind == "card"]
    assert cards[0] == cards[1]
    two = next(r for k, r in found.items() if k[0] == 2 and r.text)
    assert two.entities[0].surrogate == one.entities[1].surrogate
    woman, man, doctor = one.entities[0].surrogate, two.entities[1].surrogate, two.entities[2].surrogate
    assert woman.split()[0] == "Mrs." and woman.split()[1] in pii.GIVEN["latin", "f"]
    assert man.split()[0] == "Mr." and man.split()[1] in pii.GIVEN["latin", "m"]
    assert doctor.split()[1] in pii.GIVEN["cyrillic", "n"]
    assert found[4, "n"].text == rows[4][1] and found[4, "n"].n_entities == 0
    assert found[5, "x"].entities[0].surrogate == one.entities[-1].surrogate
    assert found[None, ""].n_entities == 0 and len(found) == 6
    other = {r.doc_id: r for r in pii.surrogates(docs.where("doc_id = 1"), "another key").collect()}
    assert other[1].text != one.text
    assert pii.surrogates(docs.limit(0), "k").count() == 0


def test_every_kind_is_found_wherever_it_stands(spark):
    cases = [
        ("Use the resolver 8.8.8.8 or 1.1.1.1 for this.", ["ip:8.8.8.8", "ip:1.1.1.1"]),
        ("--john@x.com and .john@x.com", ["email:john@x.com"] * 2),
        ("_john@x.com a.john@x.com", ["email:john@x.com", "email:a.john@x.com"]),
        ("tel.415-555-1234", ["phone:415-555-1234"]),
        ("-(212) 555-0199 or 1-800-555-1234", ["phone:(212) 555-0199", "phone:1-800-555-1234"]),
        ("tel.+1 212 555 0199", ["phone:+1 212 555 0199"]),
        ("1.1.1.1-8.8.8.8, root@9.9.9.9", ["ip:1.1.1.1", "ip:8.8.8.8", "ip:9.9.9.9"]),
        ("no.4111-1111-1111-1111", ["card:4111-1111-1111-1111"]),
        ("-DE89 3704 0044 0532 0130 00", ["iban:DE89 3704 0044 0532 0130 00"]),
        ("--Mrs. Anna Berg", ["name:Mrs. Anna Berg"]),
        ("SSN 123-45-6789, ssn.987 65 4321", ["ssn:123-45-6789", "ssn:987 65 4321"]),
        ("2001:db8::1 and 2001:0DB8:0:0:0:0:0:1.", ["ip6:2001:db8::1", "ip6:2001:0DB8:0:0:0:0:0:1"]),
        ("at ::1, a::1, [fe80::a:b]:8 or 1::.", ["ip6:::1", "ip6:a::1", "ip6:fe80::a:b", "ip6:1::"]),
        ("::ffff:1.2.3.4 64:ff9b::1.2.3.4", ["ip6:::ffff:1.2.3.4", "ip6:64:ff9b::1.2.3.4"]),
        ("a:b:c:d:e:f:1:2", ["ip6:a:b:c:d:e:f:1:2"]),
        ("1.2.3.4.5 std::add add::bad 1:2:3 000-12-3456 1-4111-1111-1111-1111 12:30:45", []),
        ("1:2:3:4:5:6:7:8:9 and 2024-01-01", []),
    ]
    docs = _docs(spark, [(i, t, "s") for i, (t, _) in enumerate(cases)], "entities")
    rows = {r.doc_id: r for r in pii.surrogates(docs, "k").collect()}
    for i, (text, expected) in enumerate(cases):
        assert [f"{e.kind}:{text[e.start:e.end]}" for e in rows[i].entities] == expected
        for e in rows[i].entities:
            assert e.surrogate in rows[i].text and text[e.start : e.end] not in rows[i].text.split()
    # Spellings of one address are one entity; the surrogate is an address again.
    one, two = (e.surrogate for e in rows[11].entities)
    assert one == two and re.fullmatch("2001:0db8(:[0-9a-f]{4}){6}", one)


def test_one_person_one_surrogate(spark):
    rows = [
        (1, "Mr John Smith met Dr John Smith. John Smith left; Mr. Smith and Smith stayed.", "s"),
        (2, "Prof. John Smith, and John Smithson", "s"),
        (3, "Mr Adam Bell and Mr Carl Bell: Mr. Bell is either.", "s"),
        (4, "Mrs. Jane Smith wrote to Mr. Smith.", "s"),
        (5, "Dr Kim Lee, Mr Kim Lee, Ms Kim Lee", "s"),
        (6, "John Smith has no title here.", "s"),
    ]
    found = {r.doc_id: r for r in pii.surrogates(_docs(spark, rows, "entities"), "k").collect()}
    one = [e.surrogate for e in found[1].entities]
    assert len(one) == 4
    name = one[0].removeprefix("Mr ")
    assert one == [f"Mr {name}", f"Dr {name}", name, f"Mr. {name.split()[1]}"]
    assert found[1].text == f"Mr {name} met Dr {name}. {name} left; Mr. {name.split()[1]} and Smith stayed."
    assert [e.surrogate for e in found[2].entities] == [f"Prof. {name}"]
    # Two persons of one family name: who is meant is open, so it is an entity of its own.
    adam, carl, either = (e.surrogate for e in found[3].entities)
    assert adam != carl and either.split()[-1] not in (adam.split()[-1], carl.split()[-1])
    jane, mister = (e.surrogate for e in found[4].entities)
    assert jane.split()[1] in pii.GIVEN["latin", "f"] and len(mister.split()) == 3
    assert len({e.surrogate.split(" ", 1)[1] for e in found[5].entities}) == 3
    assert found[6].text == rows[5][1]


def test_spellings_and_shared_parts(spark):
    rows = [
        (1, "call +1 415-555-1234, 415-555-1234, 1-415-555-1234 or (415) 555-1234", "s"),
        (2, "call +49 30 1234 5678 or +493012345678", "s"),
        (3, "a.b@corp.example.org, c@corp.example.org, a.b@other.example.org", "s"),
    ]
    found = {r.doc_id: r for r in pii.surrogates(_docs(spark, rows, "entities"), "k").collect()}
    digits = lambda e: re.sub(r"\D", "", e.surrogate)
    one = found[1].entities
    assert [e.kind for e in one] == ["phone"] * 4
    assert len({digits(e)[-10:] for e in one}) == 1
    assert one[0].surrogate.startswith("+1 ") and one[2].surrogate.startswith("1-")
    two = found[2].entities
    assert digits(two[0]) == digits(two[1]) and two[0].surrogate.startswith("+49 ")
    three = [e.surrogate.split("@") for e in found[3].entities]
    assert three[0][1] == three[1][1] != three[2][1] and len({"@".join(t) for t in three}) == 3


def test_draws_end_where_values_run_out(spark, monkeypatch):
    """More entities than surrogates of their length: later ones are longer, and all differ."""
    monkeypatch.setattr(pii, "LONGER_FROM", 1)
    octets = [f"10.0.{i}.{j}" for i in range(10) for j in range(30)]
    letters = [f"{a}@x{n}.org" for n in range(2) for a in "abcdefghijklmnopqrstuvwxyz0123456789"]
    # No address outside what the first attempts draw from.
    monkeypatch.setattr(pii, "_draw", lambda seed, n, of: pii.F.pmod(pii.F.xxhash64(seed, pii.F.lit(n)), pii.F.lit(min(of, 4))).cast("int"))
    docs = _docs(spark, [(i, f"at {t} now", "s") for i, t in enumerate(octets + letters)], "x1")
    found = [r.entities[0].surrogate for r in pii.surrogates(docs, "k").collect()]
    assert len(set(found)) == len(octets) + len(letters)


def _plain_surrogates(spark, texts, key):
    """Found spans of every text, from Python's own search, and which of them are one entity."""
    import regex

    flat = pii.ENTITY.replace("\\z", "\\Z")
    return [[(m.start(), m.end(), m[0]) for m in regex.finditer(flat, t or "")] for t in texts]


def test_spans_against_brute_force(spark):
    """Random texts: the spans are those of a plain search, and entities map one to one."""
    import random

    rng = random.Random(12)
    pool = ["a@b.co", "x.y@mail.example.org", "10.0.0.1", "10.0.0.2", "::1", "fe80::1:2", "Mr", "Dr",
            "4111 1111 1111 1111", "123-45-6789", "+1 415 555 1234", "415-555-1234", "@", ".", "-", ":",
            "DE89370400440532013000", "word", "Zoë", "12", "\n", ",", "1.2.3", "é"]
    texts = ["".join(rng.choice(pool) + rng.choice([" ", " ", "", "."]) for _ in range(rng.randint(0, 14))) for _ in range(250)]
    docs = _docs(spark, [(i, t, "s") for i, t in enumerate(texts)], "pattern")
    rows = {r.doc_id: r for r in pii.surrogates(docs, "k").collect()}
    wanted = _plain_surrogates(spark, texts, "k")
    to_surrogate, to_entity = {}, {}
    for i, text in enumerate(texts):
        own = rows[i].entities
        assert [(e.start, e.end) for e in own] == [(a, b) for a, b, _ in wanted[i]], text
        rebuilt, at = "", 0
        for e in own:
            rebuilt += text[at : e.start] + e.surrogate
            at = e.end
            plain = re.sub(r"\D", "", text[e.start : e.end]) if e.kind in ("card", "ssn", "phone") else text[e.start : e.end]
            if e.kind == "phone":
                plain = plain[-10:]
            put = re.sub(r"\D", "", e.surrogate)[-10:] if e.kind == "phone" else (
                re.sub(r"\D", "", e.surrogate) if e.kind in ("card", "ssn") else e.surrogate)
            if e.kind == "ip6":
                continue
            assert to_surrogate.setdefault((e.kind, plain), put) == put
            assert to_entity.setdefault((e.kind, put), plain) == plain
        assert rows[i].text == rebuilt + text[at:]
    assert len(to_surrogate) > 8


def test_surrogates_stay_distinct_when_draws_collide(spark, monkeypatch):
    # Draws from so few names that most of them collide.
    monkeypatch.setattr(pii, "SYLLABLES", {k: v[:2] for k, v in pii.SYLLABLES.items()})
    monkeypatch.setattr(pii, "GIVEN", {k: v[:1] for k, v in pii.GIVEN.items()})
    monkeypatch.setattr(pii, "FAMILY_SYLLABLES", 2)
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = [f"Mr. Adam Q{a}{b}" for a in letters[:5] for b in letters[:6]]
    docs = _docs(spark, [(i, f"{n} said", "s") for i, n in enumerate(names)], "found")
    found = [r.entities[0].surrogate for r in pii.surrogates(docs, "k").collect()]
    assert len(set(found)) == len(names) and all(s.startswith("Mr. Adam ") for s in found)


def test_surrogates_write_few_files_from_many_partitions(spark, monkeypatch, tmp_path):
    """The staged tables' and the result's files are a few a core, however many partitions shuffles have."""
    from tallylake.llm import common

    monkeypatch.setattr(common, "scratch_dir", lambda _, label: f"{tmp_path}/{label}-{len(list(tmp_path.iterdir()))}")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    most = 4 * spark.sparkContext.defaultParallelism
    rows = [(i, f"write to a{i}@x{i % 7}.org or Mrs. Ann Q{chr(97 + i % 26)}o", "s") for i in range(600)]
    docs = _docs(spark, rows, "files").coalesce(4)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 5 * most)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        pii.surrogates(docs, "k").write.parquet(f"{tmp_path}/out")
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    files = {p.name: len(list(p.glob("*.parquet"))) for p in tmp_path.iterdir()}
    assert max(files.values()) <= most + 8 and sum(files.values()) <= 4 * most + 16, files
    found = spark.read.parquet(f"{tmp_path}/out").collect()
    assert len(found) == 600 and all(r.n_entities == 2 for r in found)
    assert len({r.entities[0].surrogate for r in found}) == 600
    assert len({r.entities[1].surrogate for r in found}) == 26


def test_texts_are_staged_in_small_row_groups_and_read_whole(spark, monkeypatch, tmp_path):
    """Texts staged for the surrogates make small row groups and pages; all rows come back."""
    from urllib.parse import urlparse

    import pyarrow.parquet as pq

    from tallylake.llm import common

    monkeypatch.setattr(common, "scratch_dir", lambda _, label: f"{tmp_path}/{label}")
    # Hexadecimal noise: 3,000 texts of 4 KB, and one of 6 MB, which is more than a row group.
    noise = "array_join(transform(sequence(1, {n}), i -> sha2(concat(doc_id, '/', i), 256)), '')"
    docs = spark.range(3000).selectExpr("id as doc_id").selectExpr("doc_id", noise.format(n=64) + " as text")
    long = spark.range(1).selectExpr("3000L as doc_id").selectExpr("doc_id", noise.format(n=100_000) + " as text")
    docs = docs.unionByName(long).coalesce(1)
    assert pii.surrogates(docs, "k").count() == 3001
    files = spark.read.parquet(f"{tmp_path}/pii-rows").inputFiles()
    assert sum(pq.ParquetFile(urlparse(f).path).num_row_groups for f in files) >= 3
    kept = spark.read.parquet(f"{tmp_path}/pii-rows").select("doc_id", "text")
    assert kept.exceptAll(docs).count() == docs.exceptAll(kept).count() == 0
