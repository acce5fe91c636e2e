"""URL rules, WARC archives and HTML extraction on small tables."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallylake.llm import html_content, url_rules, warc

# --- URLs -----------------------------------------------------------------------------


def _slow_rule(host, path, rules):
    fits = [
        (len(h), len(p), v == "block", h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[3:] if fits else (None, "allow")


URLS = [
    ("http://WWW.Example.com/en/1?q#f", "www.example.com", "/en/1"),
    ("https://a.example.com/en/", "a.example.com", "/en/"),
    ("https://badexample.com/en/", "badexample.com", "/en/"),
    ("x://shop.net/es/a://b/c", "shop.net", "/es/a://b/c"),
    ("http://net/fr/", "net", "/fr/"),
    ("http://net/FR/", "net", "/FR/"),
    ("http://a.com", "a.com", ""),
    ("http://a.com?x=/y", "a.com", ""),
    ("http://É.com/é", "É.com", "/é"),
    ("http:///en/", "", "/en/"),
    ("//a.com/x", "", ""),
    ("", "", ""),
    (None, "", ""),
    ("http://" + "a." * 3000 + "com/" + "p/" * 5000, "a." * 3000 + "com", "/" + "p/" * 5000),
    ("http://a.com/multi\nline/x", "a.com", "/multi\nline/x"),
]


@pytest.mark.parametrize("rules", [url_rules.RULES, [], [("a.com", "/m", "block"), ("com", "", "block"), ("a.com", "/mu", "allow"), ("a.com", "/mu", "block")]])
def test_urls_against_brute_force(spark, rules):
    rows = [(i, u, "x") for i, (u, _, _) in enumerate(URLS)] + [(0, URLS[0][0], "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    found = url_rules.judge_urls(pages, url_rules.rules_table(spark, rules)).collect()
    assert len(found) == len(rows)
    for r in found:
        _, host, path = URLS[r.page_id]
        assert (r.host, r.path) == (host, path)
        assert (r.rule, r.verdict) == _slow_rule(host, path, rules)
    assert url_rules.judge_urls(pages.limit(0), url_rules.rules_table(spark, rules)).count() == 0


# --- WARC -----------------------------------------------------------------------------


def _pages(spark, rows):
    return spark.createDataFrame(
        [(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, capture string"
    )


PAGES = [
    (4, "http://a/", "same\r\n\r\nWARC/1.1\r\n"),
    (2, "http://b/", "same\r\n\r\nWARC/1.1\r\n"),
    (9, "http://b/\r\nx: y", "é" * 100_000),
    (5, None, None),
    (6, "http://c/", ""),
    (6, "http://c/", ""),
    (None, "http://d/", "same\r\n\r\nWARC/1.1\r\n"),
    (7, "http://e/", "single \x00 byte"),
]


def _digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_round_trip(spark, tmp_path):
    folder = str(tmp_path / "archives")
    captures = warc.transactions(_pages(spark, PAGES), folder, records_per_file=4)
    rows = captures.collect()
    assert len(rows) == len(PAGES)
    for r in rows:
        assert r.request.http_header.startswith("GET ") and len(r.metadata) == 1
        assert r.response.payload_digest.startswith("sha1:")
        assert bytes(r.response.payload).decode() in ({h or "" for _, _, h in PAGES} | {""})
    facts = warc.page_facts(captures).collect()
    expected = [
        (4, "revisit", 2), (2, "response", None), (9, "response", None), (5, "response", None),
        (6, "revisit", 5), (6, "revisit", 5), (None, "revisit", 2), (7, "response", None),
    ]
    html = {4: PAGES[0][2], 2: PAGES[0][2], None: PAGES[0][2], 9: PAGES[2][2], 7: PAGES[7][2]}
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in facts), key=str)
    assert got == sorted(expected, key=str)
    for r in facts:
        text = html.get(r.page_id, "")
        assert (r.payload_bytes, r.payload_digest) == (len(text.encode()), _digest(text))
    # The archives are plain WARC to any reader.
    records = []
    for path in (tmp_path / "archives").glob("*.gz"):
        own = list(warc.parse_records(io.BytesIO(gzip.decompress(path.read_bytes()))))
        assert len(own) <= 4
        records += own
    assert len(records) == 3 * len(PAGES)
    assert all(len(h["warc-record-id"]) == 1 for h, _ in records)


def test_facts_come_from_the_payloads(spark, tmp_path):
    captures = warc.transactions(_pages(spark, PAGES), str(tmp_path / "a"))
    changed = captures.withColumn(
        "response",
        F.when(
            F.col("response.type") == "response",
            F.col("response").withField("payload", F.lit(b"other")),
        ).otherwise(F.col("response")),
    )
    for r in warc.page_facts(changed).collect():
        assert (r.payload_bytes, r.payload_digest) == (5, _digest("other"))
    bare = warc.transactions(_pages(spark, PAGES), str(tmp_path / "b"), with_payloads=False)
    assert all(r.response.payload is None and r.response.payload_bytes is not None for r in bare.collect())


def test_query_assembles_payloads(spark, tmp_path, monkeypatch):
    from tallylake.llm import queries

    seen = []
    facts = warc.page_facts
    monkeypatch.setattr(warc, "page_facts", lambda df: seen.append(df) or facts(df))
    _pages(spark, PAGES).write.parquet(str(tmp_path / "pages.parquet"))
    assert queries.op4_warc_transactions(spark, str(tmp_path)).count() == len(PAGES)
    payloads = sorted(bytes(r.response.payload).decode() for r in seen[0].collect())
    assert sorted(set(payloads)) == sorted({h or "" for _, _, h in PAGES})


def test_least_size_of_revisits_and_no_pages(spark, tmp_path):
    facts = warc.page_facts(
        warc.transactions(_pages(spark, PAGES), str(tmp_path / "a"), min_revisit_bytes=1)
    )
    assert sum(r.record_type == "revisit" for r in facts.collect()) == 2
    none = warc.transactions(_pages(spark, PAGES).limit(0), str(tmp_path / "b"))
    assert none.count() == 0


def test_assembly_follows_either_direction(spark):
    row = lambda i, kind, to: (i, kind, to, None, "u", None, None, 0, "", bytearray(i.encode()))
    records = spark.createDataFrame(
        [
            row("r1", "response", []), row("q1", "request", ["r1"]), row("m1", "metadata", ["r1"]),
            row("r2", "response", ["q2"]), row("q2", "request", []), row("m2", "metadata", ["q2"]),
            row("n2", "metadata", ["r2", "q2"]), row("r3", "revisit", ["gone"]),
            row("q4", "request", ["gone"]), row("w", "warcinfo", []),
        ],
        warc.RECORD_SCHEMA,
    )
    found = {
        r.response.record_id: (r.request and r.request.record_id, [m.record_id for m in r.metadata])
        for r in warc.assemble(records).collect()
    }
    assert found == {"r1": ("q1", ["m1"]), "r2": ("q2", ["m2", "n2"]), "r3": (None, [])}


def test_cut_archive_is_an_error():
    good = b"WARC/1.1\r\nContent-Length: 4\r\n\r\nbody\r\n\r\n"
    assert [b for _, b in warc.parse_records(io.BytesIO(good * 2))] == [b"body"] * 2
    with pytest.raises(ValueError):
        list(warc.parse_records(io.BytesIO(good[:-6])))


# --- HTML -----------------------------------------------------------------------------


def test_marginals_are_exact():
    """Against the sum over all labellings of a small tree."""
    nodes = html_content.parse("<div><p>a b<b>c</b></p><ul><li>x</ul></div>")
    forest = html_content.Forest([nodes])
    rng = np.random.default_rng(1)
    model = html_content.Model(
        rng.normal(size=html_content.N_FEATURES), rng.normal(size=(html_content.N_SORTS, 2, 2))
    )
    n = len(nodes)
    weight, content = 0.0, np.zeros(n)
    for code in range(1 << n):
        y = np.array([code >> i & 1 for i in range(n)])
        s = float((forest.x @ model.node)[y == 1].sum())
        s += sum(model.edge[forest.sort[i], y[forest.parent[i]], y[i]] for i in range(1, n))
        weight += np.exp(s)
        content += np.exp(s) * y
    p, joint, total = html_content.marginals(model, forest)
    assert np.allclose(p, content / weight) and np.isclose(total, np.log(weight))
    assert np.allclose(joint[1:].sum(axis=(1, 2)), 1)


def test_held_out_accuracy():
    model = html_content.trained_model()
    rng = random.Random(77)
    forest, label = html_content.labelled_forest([html_content.labelled_page(rng) for _ in range(200)])
    p, _, _ = html_content.marginals(model, forest)
    text = np.array([x.name == html_content.TEXT and not x.text.isspace() for x in forest.texts])
    assert ((p >= 0.5) == label)[text].mean() > 0.98


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- ad --><div class="ad">Buy this now.</div>
<article><h1>The  head &amp;\n line</h1><p><b>Bold start.<br><p>Some &eacute; text that goes on, for long
enough.<script>var t="</p>";</script><p>More, with <a href="/x">a link</a> in it.</article>
<div class="comments"><p>First! A reader says so.</p></div>
<footer>&copy; all</footer></body></html>"""


def test_operator(spark):
    rows = [(1, "u", PAGE, "x"), (2, None, None, "y"), (2, "u", "", "z"), (3, "u", "<", "a"),
            (4, "u", "<div>" * 3000 + "deep", "b"), (5, "u", PAGE.replace("<article>", "<article>" + "<p>Long text, yes.</p>" * 20_000), "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = {(r.page_id, r.url): r.text for r in html_content.extract_pages(pages).collect()}
    assert found[1, "u"] == (
        "The head & line\nBold start.\nSome é text that goes on, for long enough.\n"
        "More, with a link in it."
    )
    assert found[2, None] == found[2, "u"] == ""
    assert found[5, "u"].count("Long text, yes.") == 20_000
    assert html_content.extract_pages(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    "attributes",
    [
        'href="/blog/hidden-costs"', 'title="The hidden cost"', 'data-hidden="false"',
        'data-overflow="hidden"', "href=/blog/hidden", "title='a hidden=x class=ad'",
        'data-id="comment-5"', 'data-class="sidebar"', 'data-style="display:none"',
    ],
)
def test_names_in_other_attributes_are_not_read(attributes):
    node = html_content.parse(f"<div {attributes}>text</div>")[1]
    assert not node.hidden and not node.hints
    # What follows such an attribute is read all the same.
    node = html_content.parse(f"<div {attributes} hidden ID = 'Comments'>text</div>")[1]
    assert node.hidden and node.hints == {"comment"}


def test_attributes_that_hide():
    for attributes in (
        "hidden", "HIDDEN=''", "x=1 hidden", 'a="b"hidden', "aria-hidden='true'",
        'style="color:red; display: none"', "style=display:none",
    ):
        assert html_content.parse(f"<div {attributes}>text</div>")[1].hidden
    for attributes in ('aria-hidden="false"', 'style="color:red"', "class=hidden", 'id="a" id="ad"'):
        node = html_content.parse(f"<div {attributes}>text</div>")[1]
        assert not node.hidden and not node.hints


def test_wrapper_with_hidden_in_a_value_stays(spark):
    page = PAGE.replace("<article>", '<article data-overflow="hidden">').replace(
        'href="/x"', 'href="/blog/hidden-costs" title="The hidden cost"'
    )
    pages = spark.createDataFrame([(1, "u", page), (2, "u", PAGE)], "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html_content.extract_pages(pages).collect()}
    assert found[1] == found[2] and "a link" in found[1]
