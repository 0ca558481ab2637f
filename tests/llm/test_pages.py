import itertools
import random
import re
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from segloom.llm import pages

SCHEMA = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def weights(spark, sf):
    return pages.fit(spark.read.parquet(f"{sf}/pages.parquet"))


def blocks(html):
    return [b.text for b in pages.read(html).blocks]


def cost(terminals, edges, content):
    own = sum(-t for t, c in zip(terminals, content, strict=True) if c and t < 0) + sum(t for t, c in zip(terminals, content, strict=True) if not c and t > 0)
    return own + sum(c for a, b, c in edges if content[a] != content[b])


@pytest.mark.parametrize("seed", range(60))
def test_cut_is_minimal(seed):
    """Against all labellings."""
    rng = random.Random(seed)
    n = rng.randint(1, 10)
    terminals = [rng.randint(-6, 6) for _ in range(n)]
    edges = [(rng.randrange(n), rng.randrange(n), rng.randint(0, 4)) for _ in range(rng.randint(0, 2 * n))]
    got = pages.maximum_flow(terminals, edges)
    costs = {c: cost(terminals, edges, c) for c in itertools.product((False, True), repeat=n)}
    best = min(costs.values())
    assert costs[tuple(got)] == best
    assert sum(got) == max(sum(c) for c, v in costs.items() if v == best)  # ties stay content


def test_long_chain():
    terminals = [3 if k % 7 else -4 for k in range(60_000)]
    got = pages.maximum_flow(terminals, [(k, k + 1, 1) for k in range(len(terminals) - 1)])
    assert got == [t > 0 for t in terminals]


def test_reading():
    assert blocks("<p>a  b\n c<p>d<br>e<ul><li>f<li>g</ul>h") == ["a b c", "d e", "f", "g", "h"]
    assert blocks("a<!-- x <p> --> b<script>var s='</p><p>z';</script> c<STYLE>p{}</style>") == ["a b c"]
    assert blocks("<p>1 &lt; 2 &amp; 3&nbsp;&eacute;&#233;&#x41;&copy &am") == ["1 < 2 & 3 éé" + "A© &am"]
    assert blocks("a < b <3 </ x> c") == ["a < b <3 c"]
    assert blocks('<p title="a>b" class=\'c"d\'>x</p><p title="never closed>y</p><p>z') == ["x", "y", "z"]
    assert blocks("<p>x</b></i></div></p>y<script>never closed") == ["x", "y"]
    assert blocks("<p>cut <a hre") == ["cut"]
    assert blocks("<title>no<b>no</title><select><option>no</select><p>yes<svg><text>no</text></svg>") == ["yes"]
    assert blocks("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert blocks("<ul><li>a<ul><li>b</ul>c<li>d</ul>") == ["a", "b", "c", "d"]
    assert blocks(None) == blocks("") == blocks(" \n<p> </p>") == []
    page = pages.read('<div id=navBar><a href=x>one two</a> three</div>')
    assert [(b.text, b.linked) for b in page.blocks] == [("one two three", 7)]
    assert page.elements[1].kinds == pages._BIT["menu"]


def test_held_out_layouts(weights):
    """Made pages that the fit has not seen: nearly all blocks get their label."""
    rng = random.Random(77)
    right = total = kept = wanted = both = 0
    for _ in range(300):
        html = pages.made_page(rng, [], [])
        want = [pages._MARK in b.text for b in pages.read(html).blocks]
        got = pages.content(pages.read(html.replace(pages._MARK, "")), weights)
        if len(got) != len(want):
            continue  # a text that was nothing but a mark
        right += sum(a == b for a, b in zip(got, want, strict=True))
        total, kept, wanted = total + len(want), kept + sum(got), wanted + sum(want)
        both += sum(a and b for a, b in zip(got, want, strict=True))
    assert right >= 0.97 * total and both >= 0.97 * wanted and both >= 0.96 * kept


def test_given_pages(spark, sf):
    """The article of every given page, and nothing else."""
    source = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = pages.op13_html_extraction(spark, sf).collect()
    assert len(got) == len(source)
    for r in got:
        html = source[r.page_id].html
        inner = html[html.index("<article>") + 9 : html.index("</article>")]
        want = [" ".join(unescape(re.sub(r"<[^>]+>", " ", part)).split()) for part in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(t for t in want if t)
        assert (r.n_chars, r.url) == (len(r.text), source[r.page_id].url)


PAGE = """<body class="has-sidebar"><div class="cookie-notice"><p>We use cookies to improve your visit. Read our policy.</p><button>OK</button></div>
<header><h1>The Daily Site</h1><nav><a href=/>Home</a> <a href=/n>News</a></nav></header>
<div id="content" class="row sidebar-left"><article><header><h1>A title of the story</h1></header><p>First words of a story that goes on for a while.</p>
<div class="ad-slot"><p>Buy our product now, it is the best product there is.</p></div><h2>Then</h2><p>Second words, with a <a href=x>link to more</a> in it.</p><ul><li>an item<li>another</ul>
<form><p>Leave your address for our letters.</p><input></form></article>
<section id="comments"><h3>Comments</h3><article><p>I do not agree with this story at all.</p></article></section></div>
<aside><h3>Most read</h3><p>Another story that you may want to read some time.</p></aside><footer><p>&copy; 2020 The Daily Site. All rights reserved.</p></footer>"""


def test_usual_page(weights):
    assert pages.main_text(PAGE, weights).split("\n") == [
        "A title of the story",
        "First words of a story that goes on for a while.",
        "Then",
        "Second words, with a link to more in it.",
        "an item",
        "another",
    ]


def test_cut_differs_from_single_labels(weights):
    """Neighbours decide where a block alone says little."""
    page = pages.read("<div><p>A long paragraph that says a lot about its subject, as it should.</p>" * 3 + "<div>x</div>" + "<p>And one more paragraph to close the text, with many words.</p></div>")
    alone = pages.features(page) @ weights
    bent = weights - np.eye(len(weights))[0] * (alone[3] + 0.4)  # the short block is now boilerplate by itself
    assert (pages.features(page) @ bent)[3] < 0 and pages.content(page, bent)[3]


def test_odd_tables(spark, weights):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "plain words without any tag, but with an end."), (4, "u", "<p>" + "A sentence of a long text. " * 50_000), (4, "u", "<nav><a>x</a></nav>"), (None, "u", PAGE), (None, "u", PAGE)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("text", "n_chars", "blocks", "weights", "source")})
    got = sorted((r.page_id or 0, len(r.text), r.source) for r in pages.extracted(df, weights).collect())
    n = len(pages.main_text(PAGE, weights))
    assert got == [(0, n, "x"), (0, n, "x"), (1, 0, "x"), (2, 0, "x"), (3, 45, "x"), (4, 0, "x"), (4, 27 * 50_000 - 1, "x")]
    none = spark.createDataFrame([], SCHEMA)
    assert pages.extracted(none, pages.fit(none, layouts=20)).collect() == []
