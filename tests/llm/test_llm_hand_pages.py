"""Main text of pages laid out and labelled by hand, unlike those the model is trained on."""

from __future__ import annotations

import pytest

from tallylake.llm import html_content

# Markup as sites of these sorts write it; main text stands between « and ».
PAGES = {
    "blog": """<!DOCTYPE html><html lang="en"><head><title>Rye bread</title><style>.x{color:red}</style></head>
<body class="post-template single"><div id="page"><header id="masthead" class="site-header"><a href="/">Crumb &amp; Crust</a>
<nav id="site-navigation"><ul><li><a href="/">Home</a></li><li><a href="/about">About</a></li><li><a href="/shop">Shop</a></li></ul></nav></header>
<main id="primary"><article class="post-142 type-post hentry"><h1 class="entry-title">«A rye bread for beginners»</h1>
<div class="entry-content"><p>«Rye flour behaves differently from wheat: it has little gluten, so the dough stays sticky.»</p>
<p>«Mix the flour with water at forty degrees and let it rest overnight. In the morning it should smell sour.»</p>
<h2>«What you need»</h2><ul><li>«500 g of rye flour»</li><li>«400 ml of water»</li><li>«10 g of salt»</li></ul>
<p>«Bake for an hour and leave the loaf alone until the next day.»</p></div></article>
<div id="comments" class="comments-area"><h2>3 thoughts</h2><ol class="comment-list"><li class="comment"><p>Mine came out flat, any idea why?</p></li>
<li class="comment"><p>Try a warmer place for the starter.</p></li></ol></div></main>
<aside id="secondary" class="widget-area"><section class="widget"><h2>Recent posts</h2><ul><li><a href="/a">Sourdough myths</a></li><li><a href="/b">Flour types</a></li></ul></section></aside>
<footer id="colophon" class="site-footer">Proudly baked since 2012. <a href="/privacy">Privacy</a></footer></div></body></html>""",
    "news": """<html><body><div class="cookie-consent"><p>We and our 812 partners use cookies. Accept all?</p><button>Accept</button></div>
<div class="top-nav"><a href="/world">World</a> <a href="/business">Business</a> <a href="/sport">Sport</a></div>
<div class="layout"><div class="story-body"><h1>«Harbour bridge to close for two winters»</h1>
<p>«The city council voted on Tuesday to close the harbour bridge from November until April in both of the coming winters, so that corroded cables can be replaced.»</p>
<div class="advertisement"><p>Advertisement</p></div>
<p>«Ferries will run every ten minutes at peak hours, the transport office said, and cyclists may cross free of charge.»</p>
<blockquote><p>«We looked at every alternative, and this was the least painful one.»</p></blockquote>
<p>«Shop owners on the east bank fear for their trade and have asked for compensation.»</p></div>
<div class="sidebar"><h3>Most read</h3><ol><li><a href="/1">Storm expected at the weekend</a></li><li><a href="/2">Museum reopens</a></li></ol></div></div>
<div class="newsletter-signup"><form><label>Get the morning briefing</label><input name="mail"><button>Sign up</button></form></div>
<div class="footer"><p>Terms of use. Contact us. All rights reserved.</p></div></body></html>""",
    "manual": """<html><body><nav class="toc"><ul><li><a href="#i">Install</a></li><li><a href="#u">Use</a></li></ul></nav>
<div class="breadcrumb"><a href="/">Docs</a> / <a href="/cli">Command line</a></div>
<div role="main" class="document"><div class="section" id="install"><h1>«Installing the tool»</h1>
<p>«Download the archive for your system and unpack it into a folder of your choice.»</p>
<pre>«tar xf tool.tar.gz»</pre><p>«Then add the folder to the search path.»</p>
<table><tr><td>«Option»</td><td>«Meaning»</td></tr><tr><td>«--quiet»</td><td>«print errors only»</td></tr></table></div></div>
<div class="pagination"><a href="/prev">Previous</a><a href="/next">Next</a></div><footer><p>Built with a generator.</p></footer></body></html>""",
    "essay": """<html><body><div class="nav-bar"><a href="/">Home</a><a href="/archive">Archive</a></div>
<article><header><h1>«On walking slowly»</h1></header><section><p>«I started to walk to work after the tram line was closed, and I did not stop when it opened again.»</p>
<p>«At that speed the street turns out to have details: a row of brass plates, a bakery that sells out by nine.»</p>
<p>«Nothing of this is news, and yet I had lived there for eleven years.»</p></section></article>
<div class="share-buttons"><a href="#">Share</a><a href="#">Post</a></div><div class="related"><h4>Read next</h4><a href="/x">A year without a car</a></div></body></html>""",
    "forum": """<html><body><div class="navbar"><ul><li><a href="/f">Forums</a></li><li><a href="/m">Members</a></li></ul></div>
<div class="content"><h1>«Heat pump makes a humming noise»</h1><div class="entry"><p>«Since the first frost our heat pump hums loudly for about ten minutes every hour. The installer says this is defrosting, but last year it was silent. What could be different now?»</p>
<p>«It is an air to water unit from 2019 and the filters are clean.»</p></div></div>
<div class="replies"><div class="reply"><p>Mine does the same, check the fan for ice.</p></div><div class="reply"><p>Have the refrigerant level measured.</p></div></div>
<form class="login"><label>User</label><input><label>Password</label><input type="password"></form><div class="bottom">Powered by a board</div></body></html>""",
    "plain": """<html><body><h1>«Minutes of the allotment society»</h1><p>«The meeting was opened at seven with fourteen members present.»</p>
<p>«The treasurer reported that the water bill had doubled and proposed a second meter for the lower plots.»</p>
<p>«It was agreed to repair the fence before the spring.»</p></body></html>""",
}


def _page(marked: str) -> tuple[str, str]:
    """The page without marks, and its main text block by block."""
    parts = [p.split("»")[0] for p in marked.split("«")[1:]]
    return marked.replace("«", "").replace("»", ""), "\n".join(parts)


def _scores(found: str, wanted: str) -> tuple[float, float]:
    lines, right = found.split("\n"), set(wanted.split("\n"))
    hit = sum(len(line) for line in lines if line in right)
    return hit / max(1, len("".join(lines))), hit / len(wanted.replace("\n", ""))


@pytest.fixture(scope="module")
def results():
    model = html_content.trained_model()
    pages = {name: _page(marked) for name, marked in PAGES.items()}
    texts = html_content.extract([page for page, _ in pages.values()], model)
    return {name: _scores(t, pages[name][1]) for name, t in zip(pages, texts)}


def test_precision_and_recall_on_hand_labelled_pages(results):
    precision = sum(p for p, _ in results.values()) / len(results)
    recall = sum(r for _, r in results.values()) / len(results)
    print(results)
    assert precision >= 0.9 and recall >= 0.9


def test_text_without_elements_and_headlines_in_headers():
    model = html_content.trained_model()
    found = html_content.extract(
        ["Only text, no element at all. It goes on for a while, and it has sentences.", _page(PAGES["essay"])[0]],
        model,
    )
    assert found[0].startswith("Only text") and found[1].startswith("On walking slowly")
