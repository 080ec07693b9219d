"""Operator 4: the main text of web pages, by a tree-structured graphical model over their elements.

Each block element is a node with a hidden label, content or not. A node's evidence (tag, words of
its class, id and role, share of linked text, amount of own text) gives the likelihood of each
label; parent-child potentials say how labels follow each other down the tree. One upward and one
downward pass of sum-product messages give each node's exact marginal, and the text of nodes that
are more likely content than not is kept. Likelihoods and potentials are counted over labelled
pages.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

#: Elements whose text is no text of the page, elements without an end, and elements that make no block; fixed by HTML.
_RAW = "script style textarea title"
_DROPPED = frozenset("head noscript template svg iframe object select button audio video canvas math".split())
#: Blocks at which an element of _DROPPED that lacks its end tag is over.
_BREAKS = frozenset("address article aside blockquote body center dd div dl dt figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var".split())
_CLOSES = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]),
}
_SCOPE = frozenset("ul ol dl table div section article".split())

#: A tag's name; what ends a tag or begins a quoted value in it; the end tags of _RAW.
_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r">|=\s*[\"']")
_RAW_END = {x: re.compile(rf"</{x}(?=[\s/>])[^>]*>", re.I) for x in _RAW.split()}
_ATTR = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[a-z]+")

#: What words in classes and ids tell.
_NAMED = {
    "comment": "comment comments disqus reply replies respond discussion",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo banner adsense",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc tabs pagination pager",
    "notice": "cookie cookies consent notice alert popup modal newsletter subscribe gdpr",
    "side": "sidebar side aside widget related recommended share social sharing tags",
    "head": "header masthead topbar logo byline",
    "foot": "footer copyright legal bottom",
    "form": "form login signup search contact",
    "main": "article content main post entry story body text page maincontent",
}
_GROUP = {w: k for k, words in _NAMED.items() for w in words.split()}


class Token(NamedTuple):
    """A piece of markup: where it is, and of tags the lower-case name, whether it is an end tag, and what follows the name."""

    begin: int
    end: int
    tag: str | None = None
    closes: bool = False
    attrs: str = ""


def tokens(page: str) -> Iterator[Token]:
    """The markup in page order; what lies between is text.

    An element of _RAW is one piece, up to its end tag. A tag that is not closed is text. Each
    character is looked at a bounded number of times: what is once found to have no end is not
    sought again.
    """
    at, last, quoted = 0, page.rfind(">"), {"'": True, '"': True}
    whole = True  # whether tags may hold > in quotes
    while 0 <= (begin := page.find("<", at)) < last:
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = len(page) if end < 0 else end + 3
            yield Token(begin, at)
            continue
        name = _NAME.match(page, begin + 1)
        if not name:
            at = begin + 1
            if page[at : at + 1] in ("!", "?", "/"):
                at = page.find(">", at) + 1
                yield Token(begin, at)
            continue
        at, end = name.end(), -1
        while whole and (stop := _STOP.search(page, at)):
            if stop[0] == ">":
                end = stop.end()
                break
            quote = stop[0][-1]
            close = page.find(quote, stop.end()) if quoted[quote] else -1
            quoted[quote] = close >= 0
            at = stop.end() if close < 0 else close + 1
        if end < 0:
            whole, end = False, page.find(">", name.end()) + 1
        tag, closes = name[2].lower(), bool(name[1])
        attrs = page[name.end() : end - 1]
        if tag in _RAW_END and not closes:
            stop = _RAW_END[tag].search(page, end)
            at = stop.end() if stop else len(page)
            yield Token(begin, at)
        else:
            at = end
            yield Token(begin, at, tag, closes, attrs)


class Node:
    __slots__ = ("attrs", "linked", "own", "parent", "tag", "total")

    def __init__(self, tag: str, attrs: str, parent: int):
        self.tag, self.attrs, self.parent, self.own, self.linked, self.total = tag, attrs, parent, 0, 0, 0


def _closed(found_tags: list[Token]) -> dict[int, int]:
    """For tokens that begin elements of _DROPPED: the token that ends each, if it comes before the parent's end tag."""
    found: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    count: Counter = Counter()
    for i, m in enumerate(found_tags):
        tag = m.tag
        if tag is None or tag in _VOID:
            continue
        if not m.closes:
            if not (m.attrs.endswith("/") and (tag in ("svg", "math") or count["svg"] or count["math"])):
                stack.append((tag, i))
                count[tag] += 1
        elif count[tag]:
            own = ""
            while own != tag:
                own, begin = stack.pop()
                count[own] -= 1
            if tag in _DROPPED:
                found[begin] = i
    return found


def parsed(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """The block elements, parents before children, and the blocks of text: (element, text), in page order."""
    nodes, blocks = [Node("body", "", -1)], []
    stack, pieces = [0], []
    at = links = 0

    def flush() -> None:
        if pieces:
            text = " ".join(unescape("".join(x for x, _ in pieces)).split())
            if text:
                node = nodes[stack[-1]]
                node.own += len(text)
                node.linked += sum(len(x.strip()) for x, linked in pieces if linked)
                blocks.append((stack[-1], text))
            pieces.clear()

    marks = list(tokens(page))
    closed = _closed(marks)
    until, skips = -1, False  # the last token of a dropped element; whether one without an end is open
    for i, m in enumerate(marks):
        if i <= until:
            at = m.end
            continue
        if m.begin > at and not skips:
            pieces.append((page[at : m.begin], links > 0))
        at, tag = m.end, m.tag
        if tag is None:
            continue
        if tag in _DROPPED:
            if m.closes:
                skips = False
            elif i in closed:
                until = closed[i]
            elif tag != "head" and not (tag in ("svg", "math") and m.attrs.endswith("/")):
                skips = True
            continue
        if skips:
            if tag not in _BREAKS and not (m.closes and (tag in _INLINE or any(nodes[k].tag == tag for k in stack[1:]))):
                continue
            skips = False
        if tag in _INLINE:
            if tag == "a":
                links = 0 if m.closes else 1
            continue
        flush()
        links = 0
        if m.closes:
            for k in range(len(stack) - 1, 0, -1):
                if nodes[stack[k]].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag in _VOID or tag in ("html", "body"):
            if tag == "body":
                nodes[0].attrs = m.attrs
            continue
        if nodes[stack[-1]].tag == "p":
            stack.pop()
        shut = _CLOSES.get(tag)
        if shut:
            for k in range(len(stack) - 1, 0, -1):
                own = nodes[stack[k]].tag
                if own in shut:
                    del stack[k:]
                elif own in _SCOPE and not (own == "div" and tag == "li"):
                    break
        if len(stack) < 500:  # deeper elements count as their ancestor
            nodes.append(Node(tag, m.attrs, stack[-1]))
            stack.append(len(nodes) - 1)
    if at < len(page) and not skips:
        pieces.append((page[at:], links > 0))
    flush()
    return nodes, blocks


def _groups(attrs: str) -> tuple[str, ...]:
    """The groups of a node's names: all of them, as a name may have words of several."""
    found = {_GROUP.get(w) for m in _ATTR.finditer(attrs) for w in _PART.findall((m[1] or m[2] or m[3] or "").lower())}
    return tuple(sorted(found - {None})) or (("named",) if found else ())


def evidence(nodes: list[Node]) -> list[tuple[str, tuple[str, ...], int, int]]:
    """Of each node: tag with the groups of its names, those groups, share of linked text below it, amount of its own text."""
    for x in nodes:
        x.total = x.own
    for x in reversed(nodes):
        if x.parent >= 0:
            up = nodes[x.parent]
            up.total += x.total
            up.linked += x.linked
    out = []
    for x in nodes:
        share = 3 * x.linked // x.total if x.total else -1
        named = _groups(x.attrs) if x.attrs else ()
        out.append((f"{x.tag}.{'+'.join(named)}", named, min(share, 3), (x.own > 0) + (x.own >= 25) + (x.own >= 100)))
    return out


def _values(value) -> tuple:
    """What a feature says: each group of a set is evidence of its own."""
    return (value or ("",)) if isinstance(value, tuple) else (value,)


class Model:
    """Counts over labelled pages, as smoothed likelihoods and potentials. A label is 0 (not content) or 1."""

    def __init__(self, pages: Iterator[tuple[list[tuple], list[int], list[int]]]):
        """pages: evidence, parents and labels of each page's nodes."""
        self.features: list[tuple[Counter, Counter]] = [(Counter(), Counter()) for _ in range(4)]
        follows, first = [[1.0, 1.0], [1.0, 1.0]], [1.0, 1.0]
        for seen, parents, labels in pages:
            for x, parent, label in zip(seen, parents, labels):
                for counts, value in zip(self.features, x):
                    counts[label].update(_values(value))
                if parent < 0:
                    first[label] += 1
                else:
                    follows[labels[parent]][label] += 1
        self.follows = [[x / sum(row) for x in row] for row in follows]
        self.first = [x / sum(first) for x in first]
        self.known: dict[tuple, tuple[float, float]] = {}

    def likelihood(self, x: tuple) -> tuple[float, float]:
        found = self.known.get(x)
        if found is None:
            a = b = 1.0
            for counts, value in zip(self.features, x):
                size = len(counts[0] | counts[1]) + 1
                for v in _values(value):
                    a *= (counts[0][v] + 0.5) / (counts[0].total() + 0.5 * size)
                    b *= (counts[1][v] + 0.5) / (counts[1].total() + 0.5 * size)
            found = self.known[x] = (a / (a + b), b / (a + b))
        return found

    def marginals(self, seen: list[tuple], parents: list[int]) -> list[float]:
        """The probability that each node is content, by messages up and down the tree (parents before children)."""
        (f00, f01), (f10, f11) = self.follows
        n = len(seen)
        up0, up1 = [0.0] * n, [0.0] * n
        to0, to1 = [1.0] * n, [1.0] * n  # each node's message to its parent
        for i, x in enumerate(seen):
            up0[i], up1[i] = self.likelihood(x)
        for i in range(n - 1, 0, -1):
            a, b = up0[i], up1[i]
            m0, m1 = f00 * a + f01 * b, f10 * a + f11 * b
            s = m0 + m1
            to0[i], to1[i] = m0, m1 = m0 / s, m1 / s
            p = parents[i]
            a, b = up0[p] * m0, up1[p] * m1
            s = a + b
            up0[p], up1[p] = a / s, b / s
        all0, all1 = [0.0] * n, [0.0] * n  # beliefs
        for i in range(n):
            p = parents[i]
            if p < 0:
                a, b = self.first[0] * up0[i], self.first[1] * up1[i]
            else:
                d0, d1 = all0[p] / to0[i], all1[p] / to1[i]
                a, b = up0[i] * (d0 * f00 + d1 * f10), up1[i] * (d0 * f01 + d1 * f11)
            s = a + b
            all0[i], all1[i] = max(a / s, 1e-200), max(b / s, 1e-200)
        return all1


def labelled_pages(n: int = 400, seed: int = 7) -> Iterator[tuple[list[tuple], list[int], list[int]]]:
    """Pages made of parts whose label is known: the training set, ``n`` in number.

    The element that begins a part has an attribute y with its label, 0 or 1; elements below it
    have that label too unless they say otherwise. Elements above all parts count as content if
    they hold any.
    """
    r = random.Random(seed)
    words = "stone river light under garden seven carry winter paper long letter window after morning small house".split()

    def say(low: int, high: int) -> str:
        return " ".join(r.choice(words) for _ in range(r.randint(low, high))).capitalize() + r.choice([".", ".", ".", "", "!"])

    def links(k: int) -> str:
        return "".join(f"<li><a href='/{r.choice(words)}'>{say(1, 3)}</a></li>" for _ in range(k))

    def junk() -> str:
        return r.choice([
            lambda: f"<nav y=0><ul>{links(r.randint(3, 9))}</ul></nav>",
            lambda: f"<ul y=0 class='{r.choice(['menu', 'nav', 'breadcrumbs', 'pagination'])}'>{links(r.randint(3, 9))}</ul>",
            lambda: f"<header y=0><{(h := r.choice(['h1', 'h2', 'div', 'p']))}>{say(1, 8)}</{h}><p>{say(1, 30)}</p></header>",
            lambda: f"<header y=0><ul>{links(3)}</ul><h2>{say(1, 5)}</h2></header>",
            lambda: f"<div y=0 class='{r.choice(['header', 'masthead', 'logo'])}'>{say(1, 8)}</div>",
            lambda: f"<div y=0 class='{r.choice(['ad', 'ads', 'advert', 'banner', 'sponsored'])}'>{say(3, 40)}</div>",
            lambda: f"<aside y=0><h2>{say(1, 4)}</h2><p>{say(4, 40)}</p><p>{say(4, 40)}</p></aside>",
            lambda: f"<aside y=0><h3>{say(1, 4)}</h3><p>{say(4, 40)}</p></aside>",
            lambda: f"<div y=0 class='{r.choice(['sidebar', 'widget', 'related', 'share'])}'><p>{say(4, 40)}</p><ul>{links(3)}</ul></div>",
            lambda: f"<div y=0 id='{r.choice(['cookie-notice', 'consent', 'newsletter', 'alert'])}'><p>{say(5, 30)}</p></div>",
            lambda: f"<form y=0><p>{say(2, 12)}</p><div>{say(1, 4)}</div></form>",
        ])()

    def talk() -> str:
        one = "".join(f"<{t} class='comment'><p>{say(3, 60)}</p></{t}>" for t in [r.choice(["div", "li", "article"])] for _ in range(r.randint(1, 5)))
        return f"<{(t := r.choice(['section', 'div', 'ol']))} y=0 {r.choice(['class', 'id'])}='comments'>{one}</{t}>"

    def piece() -> str:
        k = r.random()
        if k < 0.55:
            return f"<p>{say(*r.choice([(1, 3), (4, 20), (10, 80)]))}</p>"
        if k < 0.65:
            return f"<p><a href='/x'>{say(1, 20)}</a>{say(0, 30) if r.random() < 0.4 else ''}</p>"
        if k < 0.72:
            return f"<h2>{say(1, 8)}</h2>"
        if k < 0.84:
            return f"<{(u := r.choice(['ul', 'ol']))}>{''.join(f'<li>{say(1, 20)}</li>' for _ in range(r.randint(2, 6)))}</{u}>"
        if k < 0.88:
            return f"<figure><figcaption>{say(1, 12)}</figcaption></figure>"
        if k < 0.92:
            return f"<blockquote><p>{say(5, 40)}</p></blockquote>"
        if k < 0.95:
            return f"<table><tr><td>{say(1, 5)}</td><td>{say(1, 5)}</td></tr></table>"
        return f"<div>{say(5, 40)}</div>" if k < 0.98 else f"<pre>{say(5, 40)}</pre>"

    def page() -> str:
        name = r.choice(["article", "article", "main", "div class='content'", "div class='post'", "div id='main-content'", "section class='entry'", "div class='article-body'"])
        if r.random() < 0.2:  # names of articles may hold words of other groups
            more = r.choice(["share", "side-padding", "main-ad", "ad-free", "page-header", "has-sidebar", "comments-open", "search-result", "with-banner"])
            name = f"{name[:-1]} {more}'" if name.endswith("'") else f"{name} class='{more}'"
        inner = f"<h1>{say(2, 10)}</h1>" * (r.random() < 0.8) + "".join(piece() for _ in range(r.choice([r.randint(1, 6), r.randint(4, 30)])))
        if r.random() < 0.25:
            inner += junk()
        core = f"<{name} y=1>{inner}</{name.split()[0]}>"
        if r.random() < 0.3:
            core = f"<div class='{r.choice(['wrapper', 'container', 'page'])}'>{core}{junk() if r.random() < 0.5 else ''}</div>"
        foot = f"<footer y=0>{say(3, 30)}</footer>" if r.random() < 0.6 else f"<div y=0 class='{r.choice(['footer', 'copyright'])}'><p>{say(3, 30)}</p></div>"
        return "".join(junk() for _ in range(r.randint(0, 4))) + core + (talk() if r.random() < 0.4 else "") + "".join(junk() for _ in range(r.randint(0, 2))) + foot

    for _ in range(n):
        nodes, _ = parsed(page())
        labels = [-1] * len(nodes)
        for i, x in enumerate(nodes):
            said = re.search(r"\by=([01])", x.attrs)
            labels[i] = int(said[1]) if said else labels[x.parent] if x.parent >= 0 else -1
        held = [y == 1 for y in labels]
        for i in range(len(nodes) - 1, 0, -1):
            held[nodes[i].parent] |= held[i]
        yield evidence(nodes), [x.parent for x in nodes], [int(held[i]) if y < 0 else y for i, y in enumerate(labels)]


def main_text(page: str, model: Model) -> str:
    """The page's content blocks, in order, one to a line."""
    nodes, blocks = parsed(page)
    if not blocks:
        return ""
    likely = model.marginals(evidence(nodes), [x.parent for x in nodes])
    return "\n".join(text for i, text in blocks if likely[i] > 0.5)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", training_pages: int = 400) -> DataFrame:
    """The main text of each page: page_id, url, text, n_chars (code points).

    A row for each row, also of equal ids; a null or empty page gives an empty text. Markup may be
    broken or cut off anywhere. The model is trained on the driver, over ``training_pages`` labelled
    pages, and goes to the tasks as a few hundred numbers. Other columns are not read.
    """
    model = Model(labelled_pages(training_pages))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x, model) for x in batch.column(2).fill_null("").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return arrow_map(rows, extract, "page_id long, url string, text string, n_chars long")
