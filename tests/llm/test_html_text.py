"""Main text of pages: expected texts, and the cut against all labellings."""

from __future__ import annotations

import itertools
import random

from stayspark.llm import html_text

PAGES = {
    "<p>One &amp; two &lt;b&gt; &#233;\n\t x<br>y</p><p></p>": "One & two <b> é x y",
    None: "",
    "": "",
    "just text of a page that has no markup at all, and is long.": "just text of a page that has no markup at all, and is long.",
    """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
    <header class="top"><p>My site, the best one that there ever was on the net.</p></header>
    <nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About</a></li></ul></nav>
    <div class="cookie-notice">We use cookies and you have to like it, so please press here.</div>
    <article><header><h1>The title</h1></header><p><b>First <i>part</i><br><p>A second paragraph, which <a href="#">links</a> somewhere else.
    <!-- <p>no</p> --><aside>Related: other things that you may want to read some day.</aside>
    <ul><li>item one<li>item two</ul><pre>a   b</pre>
    <form><label>Your name</label><input><button>Send</button></form>
    <table><tr><td>cell</td><td>other cell</td></tr></table><p>The end &copy; of it.</p></article>
    <section id="comments"><p>I liked this article very much, thank you for all of it.</p></section>
    <footer>&copy; 2020 somebody. All rights are reserved by them.</footer></body></html>""": "The title\n\nFirst part\n\nA second paragraph, which links somewhere else.\n\nitem one\n\nitem two\n\na b\n\ncell\n\nother cell\n\nThe end © of it.",
    "<body><div class=sidebar><p>Words in the sidebar that go on for quite a while, really.</p></div><div id=content><p>Body text of the page, which is long enough.</p><p>Short.</p></div>": "Body text of the page, which is long enough.\n\nShort.",
    "<article><p>Cut off in the mid<script>x": "Cut off in the mid",
    "<article><p>Broken < tag and & sign, a<b and <": "Broken < tag and & sign, a<b and <",
}


def test_pages(spark):
    rows = [(i, f"u{i}", p, "clash") for i, p in enumerate(PAGES)] + [(None, None, "<p>Row without an id, repeated twice in here.", "x")] * 2
    docs = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    found = html_text.extract(docs).collect()
    texts = {r.page_id: r.text for r in found}
    for i, wanted in enumerate(PAGES.values()):
        if i != 7:
            assert texts[i] == wanted
    assert texts[7].startswith("Broken")
    assert len(found) == len(rows) and all(r.n_chars == len(r.text) for r in found)
    assert html_text.extract(spark.createDataFrame([], docs.schema)).count() == 0


def test_very_long_page():
    page = "<article>" + "<p>A sentence of some words, again and again. <b>x</b></p>" * 20_000 + "</article>" + "<div>" * 3000
    assert html_text.main_text(page).count("\n\n") == 19_999


def test_minimum_cut_against_all_labellings():
    rng = random.Random(9)
    for _ in range(300):
        n = rng.randint(1, 8)
        leans = [rng.randint(-6, 6) for _ in range(n)]
        edges = [(rng.randrange(n), rng.randrange(n), rng.randint(0, 5)) for _ in range(rng.randint(0, 14))]
        edges = [e for e in edges if e[0] != e[1]]

        def cost(labels):
            own = sum(abs(x) for x, y in zip(leans, labels, strict=True) if x and (x > 0) != y)
            return own + sum(w for a, b, w in edges if labels[a] != labels[b])

        assert cost(html_text.minimum_cut(leans, edges)) == min(cost(c) for c in itertools.product([False, True], repeat=n))
