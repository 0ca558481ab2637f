"""Main text of web pages, by a minimum cut between content and boilerplate.

A page is read tag by tag into blocks (text between the borders of block
elements) and the elements that hold them. A logistic regression on a block's
text, tag, place and the kinds of its elements (from tag names, roles and the
words of class and id) gives the cost of either label. In the page's graph

* a block's costs are its capacities from the source (content) and to the sink,
* neighbouring blocks are joined, the more the nearer they stand in the tree,
* every block is joined with the element that holds it, and that with the next
  element above, so that what stands together is labelled together,

and the maximum flow cuts the page where that is cheapest. Capacities are whole
numbers, so the cut does not depend on rounding; where two cuts cost the same,
blocks stay content.

Learning: pages made here from layouts (names, nesting and order of menus,
notices, adverts and so on vary) filled with texts of a bounded sample of the
given pages (`FIT_PAGES` pages by hash, `FIT_BLOCKS` blocks a page) and with
invented words; the labels are known, as the pages are made.

Never content: comments, scripts, styles, templates, the head, vector
graphics, frames and form controls. `<br>` is white space inside its block.

Cases: null html is empty and gives an empty text; text without tags is a page
of one block; tags that are never closed, closed twice or cut off at the end of
the page do not hide later text; a page is never cut, whatever its length;
repeated rows give equal rows each; an empty table gives an empty table; columns
that are not asked for are ignored.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import escape, unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.llm.common import query, table

FIT_PAGES, FIT_BLOCKS = 200, 20  # pages whose texts fill the layouts, at most about, and blocks of each
FIT_LAYOUTS = 900
SEED = 5
CERTAIN = 8.0  # log odds beyond which a block's costs do not grow
BESIDE, WITHIN, ABOVE = 1.0, 0.5, 0.25  # capacities: neighbours in one element, block and element, element and the next above
_UNIT = 1000  # of the whole-number capacities

KINDS = ("menu", "header", "footer", "side", "advert", "notice", "form", "comment", "share", "content")
_BIT = {k: 1 << i for i, k in enumerate(KINDS)}
TAG_KIND = {"nav": "menu", "menu": "menu", "header": "header", "footer": "footer", "aside": "side", "form": "form", "fieldset": "form", "label": "form", "dialog": "notice", "article": "content", "main": "content", "ins": "advert"}
ROLE_KIND = {"navigation": "menu", "menu": "menu", "menubar": "menu", "banner": "header", "contentinfo": "footer", "complementary": "side", "search": "form", "form": "form", "alert": "notice", "dialog": "notice", "alertdialog": "notice", "main": "content", "article": "content"}
NAME_WORDS = {
    "menu": "nav navbar navigation menu menubar submenu breadcrumb breadcrumbs pagination pager toolbar tabs toc skip",
    "header": "header masthead topbar topnav logo branding tagline",
    "footer": "footer foot colophon copyright legal imprint bottom",
    "side": "sidebar side aside rail widget widgets related recommended recommendations more popular trending teaser teasers tags archive",
    "advert": "ad ads advert adverts advertisement advertising adsense adsbygoogle banner sponsor sponsored promo promotion promoted outbrain taboola",
    "notice": "cookie cookies consent gdpr notice notification notifications alert popup modal overlay newsletter subscribe subscription paywall disclaimer warning message toast",
    "form": "form search searchbox login signin signup register contact poll survey",
    "comment": "comment comments commentlist disqus reply replies respond discussion feedback responses reviews guestbook",
    "share": "share sharing social follow like facebook twitter",
    "content": "article content main post entry story body text prose page blog news",
}
_WORD_BIT = {w: _BIT[k] for k, ws in NAME_WORDS.items() for w in ws.split()}

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TEXT = set("script style template noscript iframe svg canvas object audio video textarea select button title noembed noframes xmp datalist head".split())
RAW_TEXT = set("script style textarea title iframe noembed noframes xmp noscript".split())
INLINE = set("a math abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var img br wbr area map".split())
FLOWING = INLINE | HIDDEN_TEXT - {"head", "title"}  # do not end a block
IN_PARAGRAPH = INLINE | {"p"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CLOSED_WITHIN = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}

_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=]+|=[^\s/>=]*)(?:\s*=\s*)?")
_ASSIGN = re.compile(r"\s*=\s*")
_NAME_PART = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")
_MARKS = re.compile(r"[.!?…。]")


@dataclass(slots=True)
class Element:
    tag: str
    above: int
    kinds: int  # of its own
    hidden: bool
    size: int = 0  # characters of text below it
    heads: bool = False  # has a first heading, an article or a main element below it


@dataclass(slots=True)
class Block:
    text: str
    element: int
    linked: int  # characters inside links


@dataclass(slots=True)
class Page:
    elements: list[Element] = field(default_factory=lambda: [Element("html", -1, 0, False)])
    blocks: list[Block] = field(default_factory=list)


@lru_cache(maxsize=1 << 15)
def _name_kinds(names: str) -> int:
    out = 0
    for part in _NAME_PART.findall(names):
        out |= _WORD_BIT.get(part.lower(), 0)
    return out


def _attributes(html: str, at: int, unclosed: set[str]) -> tuple[dict[str, str], int]:
    """Attributes of a tag whose name ends at `at`, and the place behind the tag."""
    out: dict[str, str] = {}
    n = len(html)
    while at < n and html[at] != ">":
        m = _ATTRIBUTE.match(html, at)
        if not m or m.end() == at:
            at += 1
            continue
        name, assigned = m.group(1).lower(), _ASSIGN.search(html, m.end(1), m.end())
        at = m.end() if assigned else m.end(1)
        value = ""
        if assigned and at < n:
            quote = html[at]
            end = html.find(quote, at + 1) if quote in "\"'" and quote not in unclosed else -1
            if end >= 0:
                value, at = html[at + 1 : end], end + 1
            elif quote != ">":
                if quote in "\"'":
                    unclosed.add(quote)  # none follows, so later ones need no search
                end = at
                while end < n and html[end] not in "> \t\n\r\f":
                    end += 1
                value, at = html[at:end], end
        out.setdefault(name, value)
    return out, min(n, at + 1)


def read(html: str | None) -> Page:
    """Blocks and elements of a page, in page order."""
    page = Page()
    elements = page.elements
    html = html or ""
    n = len(html)
    open_ = [0]
    links = hidden = 0  # open links and hidden elements
    pieces: list[str] = []
    linked = 0
    unclosed: set[str] = set()
    lower = None

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                page.blocks.append(Block(text, holder(), min(linked, len(text))))
            pieces.clear()
        linked = 0

    def holder() -> int:
        for e in reversed(open_):
            if elements[e].tag not in INLINE:
                return e
        return 0

    def close(k: int) -> None:
        """Closes the open elements from the k-th on."""
        nonlocal links, hidden
        for e in open_[k:]:
            links -= elements[e].tag == "a"
            hidden -= elements[e].tag in HIDDEN_TEXT
        del open_[k:]

    at = 0
    while at < n:
        start = html.find("<", at)
        stop = n if start < 0 else start
        if stop > at and not hidden:
            piece = html[at:stop]
            pieces.append(piece)
            if links:
                linked += len(piece.strip())
        if start < 0:
            break
        m = _TAG.match(html, start)
        if not m:
            if html.startswith("<!--", start):
                end = html.find("-->", start + 4)
                at = n if end < 0 else end + 3
            elif html[start + 1 : start + 2] in ("!", "?", "/"):
                end = html.find(">", start)
                at = n if end < 0 else end + 1
            else:
                if not hidden:
                    pieces.append("<")
                at = start + 1
            continue
        tag = m.group(1).lower()
        end = m.end()
        if end < n and html[end] == ">":
            attributes, at = {}, end + 1
        else:
            attributes, at = _attributes(html, end, unclosed)
        if html[start + 1] == "/":
            if tag not in FLOWING:
                flush()
            for k in range(len(open_) - 1, 0, -1):
                other = elements[open_[k]].tag
                if other == tag:
                    close(k)
                    break
                if tag in INLINE and other not in INLINE:
                    break  # a link or emphasis ends inside its block
            continue
        if tag == "br":
            if not hidden:
                pieces.append(" ")
            continue
        if tag not in FLOWING:
            flush()
            if elements[open_[-1]].tag in IN_PARAGRAPH:
                # A block element ends a paragraph that is open, and the emphasis inside.
                k = len(open_)
                while k > 1 and elements[open_[k - 1]].tag in INLINE:
                    k -= 1
                if k > 1 and elements[open_[k - 1]].tag == "p":
                    close(k - 1)
            if tag == "body":
                close(1)  # a head that was not closed
            for k in range(len(open_) - 1, 0, -1):
                other = elements[open_[k]].tag
                if other in CLOSED_WITHIN.get(tag, ()):
                    break
                if other in CLOSES.get(tag, ()):
                    close(k)
                    break
        elif tag == "a" and links:
            for k in range(len(open_) - 1, 0, -1):
                if elements[open_[k]].tag == "a":
                    close(k)
                    break
        if tag in VOID:
            continue
        if tag in RAW_TEXT:
            # Its text has no tags; it ends with its own end tag.
            lower = lower if lower is not None else html.lower() if html.isascii() else re.sub(r"[A-Z]+", lambda x: x.group().lower(), html)
            end = lower.find("</" + tag, at)
            stop = html.find(">", end) if end >= 0 else -1
            at = n if stop < 0 else stop + 1
            continue
        kinds = 0
        if tag in TAG_KIND and not (tag == "header" and any(elements[e].tag in ("article", "main") for e in open_)):
            kinds = _BIT[TAG_KIND[tag]]
        concealed = False
        if attributes:
            names = attributes.get("class", "") + " " + attributes.get("id", "")
            if len(names) > 1 and tag not in ("html", "body"):
                kinds |= _name_kinds(names)
            kinds |= _BIT.get(ROLE_KIND.get(attributes.get("role", "").lower(), ""), 0)
            concealed = "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower()
        elements.append(Element(tag, open_[-1], kinds, concealed))
        open_.append(len(elements) - 1)
        links += tag == "a"
        hidden += tag in HIDDEN_TEXT
    flush()
    return page


def _kinds(page: Page) -> list[tuple[int, bool]]:
    """Per element the kinds of itself and all above it, and whether any of them is hidden."""
    elements = page.elements
    for b in page.blocks:
        elements[b.element].size += len(b.text)
    for e in reversed(elements[1:]):
        above = elements[e.above]
        above.size += e.size
        above.heads |= e.heads or e.tag in ("h1", "article", "main")
    whole = elements[0].size
    out: list[tuple[int, bool]] = []
    for e in elements:
        kinds, hidden = out[e.above] if e.above >= 0 else (0, False)
        own = e.kinds
        if e.heads and 2 * e.size > whole and (e.tag == "form" or e.tag not in TAG_KIND):
            own &= _BIT["content"]  # names of an element around most of the page say how the page looks, not what it is
        out.append((kinds | own, hidden or e.hidden))
    return out


FEATURES = ("one", "words", "linked", "marks", "ends", "paragraph", "heading", "item", "place", "after heading", "sign", "hidden", *KINDS)


def features(page: Page) -> np.ndarray:
    """One row per block, one column per name in FEATURES."""
    kinds = _kinds(page)
    out = np.zeros((len(page.blocks), len(FEATURES)))
    last = max(1, len(page.blocks) - 1)
    headed = False
    for k, b in enumerate(page.blocks):
        tag = page.elements[b.element].tag
        words = b.text.count(" ") + 1
        bits, hidden = kinds[b.element]
        row = (1, np.log1p(words), b.linked / len(b.text), min(1, len(_MARKS.findall(b.text)) / words), b.text[-1] in ".!?…。:;\"”»)", tag in ("p", "blockquote", "pre"), tag in HEADINGS, tag in ("li", "dt", "dd"), k / last, headed, "©" in b.text, hidden)
        out[k, : len(row)] = row
        out[k, len(row) :] = [bits >> i & 1 for i in range(len(KINDS))]
        headed |= tag == "h1"
    return out


# --- the cut


def maximum_flow(terminals: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay on the source's side of a minimum cut, the larger side where several cuts cost the same.

    `terminals` has for every node what its capacity from the source exceeds that
    to the sink by (the rest flows through the node at once); `edges` are
    (node, node, capacity both ways). Level graphs and blocking flows (Dinic).
    """
    n = len(terminals)
    if all(t >= 0 for t in terminals) or all(t < 0 for t in terminals):
        return [t >= 0 for t in terminals]
    spare = list(terminals)  # positive: still comes from the source; negative: still fits to the sink
    to: list[int] = []
    room: list[int] = []
    out: list[list[int]] = [[] for _ in range(n)]
    for a, b, c in edges:
        if c > 0 and a != b:
            out[a].append(len(to))
            to.append(b)
            room.append(c)
            out[b].append(len(to))
            to.append(a)
            room.append(c)
    while True:
        level = [-1] * n
        now = [v for v in range(n) if spare[v] > 0]
        for v in now:
            level[v] = 0
        depth, reached = 0, False
        while now and not reached:
            depth += 1
            after = []
            for v in now:
                for e in out[v]:
                    w = to[e]
                    if room[e] and level[w] < 0:
                        level[w] = depth
                        after.append(w)
                        reached |= spare[w] < 0
            now = after
        if not reached:
            break
        tried = [0] * n
        for s in range(n):
            while spare[s] > 0 and level[s] == 0:
                path: list[int] = []
                v = s
                while not (spare[v] < 0 and path):
                    for k in range(tried[v], len(out[v])):
                        e = out[v][k]
                        if room[e] and level[to[e]] == level[v] + 1:
                            tried[v] = k
                            path.append(e)
                            v = to[e]
                            break
                    else:
                        tried[v] = len(out[v])
                        level[v] = -1
                        if not path:
                            break
                        v = to[path.pop() ^ 1]
                if not path:
                    break
                moved = min(spare[s], -spare[v], *(room[e] for e in path))
                for e in path:
                    room[e] -= moved
                    room[e ^ 1] += moved
                spare[s] -= moved
                spare[v] += moved
    # Everything that can still send to the sink is boilerplate.
    sink = [spare[v] < 0 for v in range(n)]
    now = [v for v in range(n) if sink[v]]
    while now:
        v = now.pop()
        for e in out[v]:
            w = to[e]
            if not sink[w] and room[e ^ 1]:
                sink[w] = True
                now.append(w)
    return [not x for x in sink]


def graph(page: Page) -> tuple[int, list[tuple[int, int, int]]]:
    """(number of nodes, edges): blocks first, then the elements around them."""
    edges = []
    elements, blocks = page.elements, page.blocks
    depth = [0] * len(elements)
    for k, e in enumerate(elements[1:], 1):
        depth[k] = depth[e.above] + 1
    for k in range(len(blocks) - 1):
        a, b = blocks[k].element, blocks[k + 1].element
        steps = 0
        while a != b:
            if depth[a] >= depth[b]:
                a = elements[a].above
            else:
                b = elements[b].above
            steps += 1
        # Two paragraphs of an element are two steps apart, and as near as two texts right inside it.
        edges.append((k, k + 1, round(_UNIT * BESIDE / (1 + max(0, steps - 2)))))
    node: dict[int, int] = {}

    def wide(e: int) -> bool:
        return e > 0 and elements[e].tag not in ("html", "body")

    for k, b in enumerate(blocks):
        e, below, capacity = b.element, k, WITHIN
        while wide(e):
            new = e not in node
            if new:
                node[e] = len(blocks) + len(node)
            edges.append((below, node[e], round(_UNIT * capacity)))
            if not new:
                break
            e, below, capacity = elements[e].above, node[e], ABOVE
    return len(blocks) + len(node), edges


def content(page: Page, weights: np.ndarray) -> list[bool]:
    """Which blocks are content."""
    if not page.blocks:
        return []
    odds = np.clip(features(page) @ weights, -CERTAIN, CERTAIN)
    nodes, edges = graph(page)
    terminals = np.rint(odds * _UNIT).astype(int).tolist() + [0] * (nodes - len(page.blocks))
    return maximum_flow(terminals, edges)[: len(page.blocks)]


def main_text(html: str | None, weights: np.ndarray) -> str:
    page = read(html)
    return "\n".join(b.text for b, keep in zip(page.blocks, content(page, weights), strict=True) if keep)


# --- learning

_MARK = "\ue000"  # before every content text of a made page; it never leaves this module
_PARTS = {
    "menu": ["nav", "ul.menu", "div.navbar", "div#navigation", "div.breadcrumbs", "div.main-menu", "div@navigation"],
    "header": ["header", "div.site-header", "div#masthead", "div.topbar", "div@banner"],
    "footer": ["footer", "div.footer", "div#colophon", "div.site-footer", "div@contentinfo"],
    "side": ["aside", "div.sidebar", "div#sidebar", "section.related-posts", "div.widget", "div@complementary"],
    "advert": ["div.ad", "div.ads", "div.advertisement", "div#ad-slot-1", "ins.adsbygoogle", "div.sponsored", "div.promo"],
    "notice": ["div.cookie-notice", "div#consent", "dialog", "div.alert", "div.newsletter-popup", "div@alert", "div.notice"],
    "form": ["form", "div.search-form", "form.login", "div.signup"],
    "comment": ["section.comments", "div#comments", "ol.commentlist", "div.disqus", "div#respond"],
    "share": ["div.share", "div.social-links", "ul.follow"],
}
_AROUND = ["article", "main", "div.post-content", "div#content", "div.entry", "section.story", "div", "section", "", "main>article", "div.page>div.article-body", "article>div"]


def _opened(name: str) -> tuple[str, str]:
    before = after = ""
    for part in filter(None, name.split(">")):
        tag, sign, value = re.match(r"(\w+)([.#@]?)(.*)", part).groups()
        attribute = {".": "class", "#": "id", "@": "role"}.get(sign)
        before += f'<{tag} {attribute}="{value}">' if attribute else f"<{tag}>"
        after = f"</{tag}>" + after
    return before, after


def made_page(rng: random.Random, long: list[str], short: list[str]) -> str:
    """A page of a random layout; content texts start with a mark."""

    def words(low: int, high: int) -> str:
        if rng.random() < 0.5:
            pool = short if high < 8 else long
            if pool:
                return escape(" ".join(rng.choice(pool).split()[:high]))
        return " ".join("".join(rng.choice("abcdeilmnorstu") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(low, high)))

    def sentence(low: int = 4, high: int = 30) -> str:
        return words(low, high).capitalize() + rng.choice([".", ".", ".", "!", "?", ""])

    def part(kind: str) -> str:
        before, after = _opened(rng.choice(_PARTS[kind]))
        if rng.random() < 0.05:
            before, after = f'<div style="display: none">{before}', f"{after}</div>"
        if rng.random() < 0.3:
            wrap = _opened(rng.choice(["div.content", "div.inner", "div.wrap", "div"]))
            before, after = before + wrap[0], wrap[1] + after
        links = lambda k: "<ul>" + "".join(f'<li><a href="/{i}">{words(1, 4)}</a></li>' for i in range(rng.randint(2, k))) + "</ul>"
        body = {
            "menu": lambda: links(9) if rng.random() < 0.8 else " ".join(f'<a href="/{i}">{words(1, 3)}</a>' for i in range(4)),
            "header": lambda: rng.choice([f"<h1>{words(1, 4)}</h1>", f"<a href='/'>{words(1, 3)}</a>", f"<p>{words(2, 7)}</p>", f"<div>{words(1, 5)}</div>"]) + (links(6) if rng.random() < 0.4 else ""),
            "footer": lambda: rng.choice(["&copy; ", ""]) + sentence(2, 20) + (links(6) if rng.random() < 0.4 else ""),
            "side": lambda: f"<h3>{words(1, 4)}</h3>" + rng.choice([links(8), f"<p>{sentence()}</p>", f"<div>{sentence()}</div>"]),
            "advert": lambda: rng.choice([sentence(), f"<p>{sentence()}</p>", f'<a href="/x">{sentence(2, 8)}</a>', f"<h3>{words(1, 5)}</h3><p>{sentence()}</p>"]),
            "notice": lambda: rng.choice([sentence(), f"<p>{sentence()}</p>", f"<p>{sentence()}</p><a href='/'>{words(1, 2)}</a>"]),
            "form": lambda: f"<label>{words(1, 3)}</label><input><p>{words(2, 8)}</p>",
            "comment": lambda: f"<h3>{words(1, 3)}</h3>" + "".join(rng.choice(["<div><p>%s</p></div>", "<li>%s</li>", "<article><p>%s</p></article>", "<p>%s</p>"]) % sentence() for _ in range(rng.randint(1, 6))),
            "share": lambda: links(5) if rng.random() < 0.6 else words(1, 4),
        }[kind]()
        return before + body + after

    def paragraph() -> str:
        text = _MARK + " ".join(sentence() for _ in range(rng.choice([1, 1, 2, 3, 5, 8])))
        if rng.random() < 0.15:
            text = _MARK + words(1, 4)
        if rng.random() < 0.2:
            text += f' <a href="/y">{words(1, 4)}</a> {sentence()}'
        shape = rng.random()
        if shape < 0.7:
            return f"<p>{text}</p>"
        if shape < 0.78:
            return f"<h{rng.randint(2, 4)}>{_MARK}{words(1, 7)}</h2><p>{text}"
        if shape < 0.86:
            return "<ul>" + "".join(f"<li>{_MARK}{sentence(2, 15)}</li>" for _ in range(rng.randint(1, 5))) + "</ul>"
        if shape < 0.92:
            return f"<blockquote>{text}</blockquote>"
        return f"<div>{text}</div>" if shape < 0.97 else f"<table><tr><td>{_MARK}{words(1, 5)}<td>{_MARK}{words(1, 5)}</table>"

    before, after = _opened(rng.choice(_AROUND))
    title = f"<h1>{_MARK}{words(1, 10)}</h1>"
    body = [paragraph() for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 13]))]
    for kind in ("advert", "share", "notice"):
        if rng.random() < 0.2:
            body.insert(rng.randint(0, len(body)), part(kind))
    some = lambda kinds, share: "".join(part(k) for k in kinds if rng.random() < share)
    head = some(("notice", "header", "menu", "advert", "form"), 0.5)
    tail = some(("share", "comment", "side", "form", "advert", "menu"), 0.35) + some(("footer",), 0.8)
    inside = some(("comment", "side", "share"), 0.15)
    headed = rng.random()
    title = title if headed < 0.75 else f"<header>{title}</header>" if before.startswith(("<article", "<main")) else ""
    if rng.random() < 0.1:
        around = _opened(rng.choice(["div.page-wrap", "div.has-sidebar", "form", "div#main>div.row"]))
        before, after = around[0] + before, after + around[1]
    return f"<html><head><title>{words(1, 9)}</title></head><body>{head}{before}{title}{''.join(body)}{inside}{after}{tail}</body></html>"


def labelled(html: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of a made page."""
    page = read(html)
    y = np.array([_MARK in b.text for b in page.blocks], float)
    for b in page.blocks:
        b.text = b.text.replace(_MARK, "") or "."
    return features(page), y


def _regression(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton's method."""
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(len(w))
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(pages: DataFrame, html: str = "html", layouts: int = FIT_LAYOUTS) -> np.ndarray:
    """Weights of the regression, from made pages filled with texts of a bounded sample of the given pages."""

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["html"]:
                page = read(text)
                step = max(1, len(page.blocks) // FIT_BLOCKS)
                for b in page.blocks[::step][:FIT_BLOCKS]:
                    rows.append(" ".join(b.text.split(" ")[:60]))
            yield pd.DataFrame({"text": pd.Series(rows, dtype=object)})

    source = pages.select(F.col(html).alias("html")).where("html IS NOT NULL")
    share = min(1.0, FIT_PAGES / max(1, source.count()))
    sample = source.where(F.pmod(F.xxhash64("html", F.lit(SEED)), F.lit(1 << 30)) < int((1 << 30) * share))
    # Copies of a page have one hash, so the sample takes each different text once, and counts are bounded after that.
    pool = sorted(r["text"] for r in sample.distinct().limit(2 * FIT_PAGES).mapInPandas(texts, "text string").collect())
    rng = random.Random(SEED)
    long, short = [t for t in pool if t.count(" ") >= 8], [t for t in pool if t.count(" ") < 8]
    made = [labelled(made_page(rng, long, short)) for _ in range(layouts)]
    return _regression(np.concatenate([x for x, _ in made]), np.concatenate([y for _, y in made]))


def extracted(pages: DataFrame, weights: np.ndarray, html: str = "html") -> DataFrame:
    """`pages` with the column `text` set to the main text of each page."""

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(h, weights) for h in batch], dtype=object)

    return pages.withColumn("text", extract(F.col(html)))


@query("op13_html_extraction")
def op13_html_extraction(spark, sf_dir):
    """Main text of all pages."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    done = extracted(pages, fit(pages))
    return done.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
