"""The main text of web pages, by boosted trees over the nodes of their document tree.

A page is read into a tree of block elements (inline markup is transparent, implied ends
are closed as browsers close them), whose leaves are runs of text. Every node gets a row of
numbers: its tag, the words in its class, id and role and in those above it, depth, length,
text per tag, links, sentences, and how it stands among its siblings and in the page. Boosted
trees give the probability that main text lies in the node. The decoding takes the labels of
the whole tree that are likeliest together, where a node has main text if and only if one of
its children has: no text is kept below a dropped node, and no node is kept empty.

Nobody has labelled the pages, so the trees learn from pages that the layout rules below
(``layout``) compose: texts sampled from the table are put into articles, menus, headers,
notices, adverts, forms, comments and footers, marked up in many ways, so that the truth is
known. To them come sampled pages as they are, where their own ``article`` or ``main`` shows
the truth. At most ``SAMPLE_PAGES`` pages are sampled, ``RUNS_PER_PAGE`` texts of
``RUN_CHARS`` characters of each; the number of composed pages is ``COMPOSED``. Extraction is
one pass over all pages, without a shuffle.

Defined results: a null or empty page, and one without main text, gives an empty text; page
references of any kind (also cut ones) are decoded as browsers do; unclosed and misplaced tags
close as far as they can; scripts, styles, templates, titles and comments of the markup are no
text; a page of any length or depth is read whole; rows with equal or null ids give a text
each; a table without any text gives a model that keeps nothing. Other columns are not
looked at."""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riftlog.llm.labelled import bounded_sample
from riftlog.llm.quality_model import Trees, fit_trees
from riftlog.llm.text import carried

SAMPLE_PAGES, RUNS_PER_PAGE, RUN_CHARS, COMPOSED = 200, 40, 1500, 400
ROWS_AT_ONCE = 256

#: Elements of HTML by how they stand in the text.
TAGS = {
    "body": ["body"], "article": ["article"], "main": ["main"], "section": ["section"], "division": ["div", "center", "details", "summary", "dialog"],
    "nav": ["nav", "menu"], "header": ["header", "hgroup"], "footer": ["footer", "address"], "aside": ["aside"], "form": ["form", "fieldset", "legend"],
    "list": ["ul", "ol", "dl"], "item": ["li", "dt", "dd"], "paragraph": ["p"], "heading": ["h1", "h2", "h3", "h4", "h5", "h6"],
    "table": ["table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption"], "quote": ["blockquote", "pre", "figure", "figcaption"], "text": ["#text"],
}
BLOCK = {tag: i for i, tags in enumerate(TAGS.values()) for tag in tags}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript template iframe noframes noembed xmp svg math object audio video canvas select datalist".split())
CONTROLS = set("input button select textarea".split())
#: Words of class, id and role, by what they are used for.
ROLES = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager tabs toc skip sitemap topnav dropdown",
    "header": "header masthead banner topbar logo branding hero",
    "footer": "footer contentinfo copyright colophon legal bottom imprint",
    "side": "sidebar side aside widget widgets related recommended recommendations popular trending complementary rail more teaser teasers",
    "notice": "notice notices cookie cookies consent gdpr alert popup modal overlay toast warning message disclaimer privacy announcement infobar",
    "advert": "ad ads adv advert adverts advertisement advertising adslot adsense sponsor sponsored sponsors promo promoted promotion dfp outbrain taboola",
    "form": "form search searchbox login signin signup register subscribe subscription newsletter contact input field",
    "comment": "comment comments commentlist commentary reply replies respond disqus discussion responses feedback reviews review reader",
    "share": "share sharing social follow likes tweet buttons toolbar tags meta byline author",
    "main": "article content main post entry story body text blogpost hentry page copy maincontent articlebody bodytext",
    "hidden": "hidden invisible visuallyhidden offscreen print noprint",
}
ROLE = {word: 1 << i for i, words in enumerate(ROLES.values()) for word in words.split()}
BOILER_ROLES = sum(1 << i for i, r in enumerate(ROLES) if r not in ("main", "header", "share"))
BOILER_TAGS = sum(1 << i for i, t in enumerate(TAGS) if t in ("nav", "footer", "aside", "form"))
MAIN_TAGS = sum(1 << i for i, t in enumerate(TAGS) if t in ("article", "main"))
_SCOPE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "tr": {"table", "tbody", "thead", "tfoot"}}
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}}

TOKEN = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+)(?:>|\Z)|<(?:[!?]|/(?=[^\s]))[^>]*+(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|style|hidden|aria-hidden)\s*+(?:=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in RAW}
TELLING = {"article", "main", "nav", "header", "footer", "aside", "form"}  # tags that say what they hold
MARK = "\ue000"  # stands before the main text of composed pages


def _roles(attributes: str) -> int:
    found = 0
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id", "role"):
            for word in _WORDS.findall(value):
                found |= ROLE.get(word.lower(), 0)
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and "display:none" in value.lower().replace(" ", ""):
            found |= ROLE["hidden"]
    return found


@dataclass
class Nodes:
    """Block elements and runs of text of some pages, in page order."""

    tag: list[int] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)  # index after the last descendant
    depth: list[int] = field(default_factory=list)
    own: list[int] = field(default_factory=list)  # roles of the element
    above: list[int] = field(default_factory=list)  # roles of the elements around it
    within: list[int] = field(default_factory=list)  # tags of the elements around it
    controls: list[int] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)  # characters in links
    roots: list[int] = field(default_factory=list)

    def add(self, tag: int, parent: int, roles: int, text: str = "", linked: int = 0) -> int:
        at = len(self.tag)
        self.tag.append(tag)
        self.parent.append(parent)
        self.end.append(at + 1)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.own.append(roles)
        self.above.append(self.above[parent] | self.own[parent] if parent >= 0 else 0)
        self.within.append(self.within[parent] | 1 << self.tag[parent] if parent >= 0 else 0)
        self.controls.append(0)
        self.text.append(text)
        self.linked.append(linked)
        return at


def read_page(page: str, nodes: Nodes) -> None:
    """Adds the tree of a page to ``nodes``."""
    root = nodes.add(BLOCK["body"], -1, 0)
    nodes.roots.append(root)
    stack, names, open_tags = [root], ["body"], {"body": 1}
    parts: list[str] = []
    in_link, link_chars = False, 0

    def flush() -> None:
        nonlocal link_chars
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                nodes.add(BLOCK["#text"], stack[-1], 0, text, min(link_chars, len(text)))
            parts.clear()
        link_chars = 0

    def close(size: int) -> None:
        for at, name in zip(stack[size:], names[size:]):
            nodes.end[at] = len(nodes.tag)
            open_tags[name] -= 1
        del stack[size:], names[size:]

    position, length = 0, len(page)
    while position < length:
        token = TOKEN.search(page, position)
        piece = page[position : token.start() if token else length]
        if piece:
            piece = html.unescape(piece) if "&" in piece else piece
            parts.append(piece)
            if in_link:
                link_chars += len(piece.strip())
        if not token:
            break
        position = token.end()
        if token[2] is None:
            continue
        tag, ending = token[2].lower(), token[1] == "/"
        if tag in CONTROLS and not ending:
            nodes.controls[stack[-1]] += 1
        if tag in RAW and not ending:
            if not token[3].endswith("/") or tag not in ("svg", "math"):
                found = _RAW_END[tag].search(page, position)
                position = found.start() if found else length
            if tag != "title":
                parts.append(" ")
            continue
        if tag in ("br", "wbr", "img", "input"):
            parts.append("" if tag == "wbr" else " ")
            continue
        if tag == "a":
            in_link = not ending
            continue
        if tag == "hr":
            flush()
            continue
        if tag not in BLOCK or tag in VOID:
            continue
        flush()
        if tag == "body":
            nodes.own[root] |= _roles(token[3]) if not ending else 0
            continue
        if ending:
            if open_tags.get(tag):
                size = len(names) - 1
                while names[size] != tag:
                    size -= 1
                close(size)
            continue
        if names[-1] == "p" or BLOCK[tag] == BLOCK["h1"] == BLOCK.get(names[-1]):
            close(len(names) - 1)
        if tag in _CLOSES and any(open_tags.get(t) for t in _CLOSES[tag]):
            size = len(names) - 1
            while size > 0 and names[size] not in _CLOSES[tag] and names[size] not in _SCOPE[tag]:
                size -= 1
            if names[size] in _CLOSES[tag]:
                if tag == "tr":  # a cell goes with its row
                    while size > 0 and names[size] != "tr":
                        size -= 1
                close(size)
        stack.append(nodes.add(BLOCK[tag], stack[-1], _roles(token[3]) if len(token[3]) > 3 else 0))
        names.append(tag)
        open_tags[tag] = open_tags.get(tag, 0) + 1
    flush()
    close(0)


@dataclass
class Table:
    """The nodes with text of some pages, as arrays; a text that is alone in its element
    stands for the element."""

    parent: np.ndarray
    x: np.ndarray  # features
    text: list[str]  # of leaves, else empty
    root: np.ndarray  # of each page, -1 where it has no text


def _inside(value: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(value))
    return total[end] - total[:-1]


def node_table(nodes: Nodes) -> Table:
    """Features of all nodes that have text."""
    tag, parent, end, depth, own, above, within, controls, linked = (
        np.array(v, np.int64)
        for v in (nodes.tag, nodes.parent, nodes.end, nodes.depth, nodes.own, nodes.above, nodes.within, nodes.controls, nodes.linked)
    )
    n = len(tag)
    chars = np.fromiter(map(len, nodes.text), np.int64, n)
    words = np.fromiter((t.count(" ") + 1 if t else 0 for t in nodes.text), np.int64, n)
    stops = np.fromiter((t.count(". ") + t.count("! ") + t.count("? ") + (t[-1:] in ".!?" if t else 0) for t in nodes.text), np.int64, n)
    commas = np.fromiter((t.count(",") for t in nodes.text), np.int64, n)
    signs = np.fromiter((("©" in t) + t.count("|") + t.count("·") + t.count("»") for t in nodes.text), np.int64, n)
    is_text = tag == BLOCK["#text"]
    one = np.ones(n)
    size, run_chars, run_words, run_links = (_inside(v, end) for v in (one, chars, words, linked))
    run_stops, run_commas, run_signs, run_controls, runs = (_inside(v, end) for v in (stops, commas, signs, controls, is_text))
    around, tags = above | own, within | 1 << tag
    boiler = (around & BOILER_ROLES > 0) | (tags & BOILER_TAGS > 0)
    clean = _inside(np.where(boiler, 0, chars), end)
    shown = _inside(np.where(~boiler & ((around & ROLE["article"] > 0) | (tags & MAIN_TAGS > 0)), chars, 0), end)
    heads, items, paragraphs = (_inside(tag == BLOCK[t], end) for t in ("h1", "li", "p"))
    sentences = _inside(np.where((words >= 8) & (stops > 0), chars, 0), end)

    # Keep what has text; an only text is its element.
    alone = np.zeros(n, bool)
    held = np.bincount(parent[is_text], minlength=n)
    alone[is_text] = (size[parent[is_text]] == 2) & (held[parent[is_text]] == 1)
    keep = (run_chars > 0) & ~alone
    texts = list(nodes.text)
    for i in np.flatnonzero(alone):
        texts[parent[i]] = nodes.text[i]
    at = np.flatnonzero(keep)
    number = np.cumsum(keep) - 1
    up = np.where(parent[at] >= 0, number[np.maximum(parent[at], 0)], -1)
    is_root = up < 0
    top = np.maximum(up, 0)
    pages = np.cumsum(is_root) - 1
    root = np.flatnonzero(is_root)[pages] if len(at) else np.empty(0, np.int64)

    c, w, links = run_chars[at].astype(float), run_words[at].astype(float), run_links[at] / np.maximum(run_chars[at], 1)
    order = np.lexsort((np.arange(len(at)), up, pages))
    same = np.append(False, (up[order][1:] == up[order][:-1]) & ~is_root[order][1:])
    begin = np.maximum.accumulate(np.where(~same, np.arange(len(at)), 0))
    index = np.empty(len(at))
    index[order] = np.arange(len(at)) - begin
    siblings = np.bincount(top[~is_root], minlength=len(at)).astype(float)
    children = siblings.copy()
    siblings = np.where(is_root, 1, siblings[top])
    before, after = np.zeros((len(at), 3)), np.zeros((len(at), 3))
    near = np.stack([np.log1p(c), links, run_stops[at] / np.maximum(w, 1)], 1)
    before[order[1:]] = np.where(same[1:, None], near[order[:-1]], -1)
    after[order[:-1]] = np.where(same[1:, None], near[order[1:]], -1)
    seen = np.append(0, np.cumsum(chars))[at]
    everything = np.maximum(c[root], 1) if len(at) else c
    own_chars = np.where(is_text, chars, 0)
    direct = np.bincount(np.maximum(parent, 0), np.where(parent >= 0, own_chars, 0), n)[at] + own_chars[at]
    columns = [
        *[(tag[at] == i).astype(float) for i in range(len(TAGS))],
        *[(own[at] >> i & 1).astype(float) for i in range(len(ROLES))],
        *[(above[at] >> i & 1).astype(float) for i in range(len(ROLES))],
        *[(within[at] >> i & 1).astype(float) for i in range(1, len(TAGS) - 1)],
        depth[at], np.log1p(c), np.log1p(w), c / np.maximum(w, 1), links, run_stops[at] / np.maximum(w, 1), run_commas[at] / np.maximum(w, 1),
        np.log1p(run_signs[at]), run_controls[at], c / size[at], c / np.maximum(runs[at], 1), np.log1p(runs[at]), np.log1p(children),
        clean[at] / np.maximum(c, 1), shown[at] / np.maximum(c, 1), direct / np.maximum(c, 1), sentences[at] / np.maximum(c, 1), heads[at], items[at] / size[at], paragraphs[at] / size[at],
        c / everything, (seen - seen[root]) / everything if len(at) else c, index, siblings, index / siblings, *before.T, *after.T,
        c / np.maximum(c[top], 1), links[top] if len(at) else links, np.log1p(c[top]),
    ]
    where = np.full(len(nodes.roots), -1, np.int64)
    for i, r in enumerate(nodes.roots):
        if keep[r]:
            where[i] = number[r]
    return Table(up, np.stack(columns, 1).astype(np.float32), [texts[i] for i in at], where)


def decode(parent: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The likeliest labels in which a node has main text if and only if a child has, given
    the probability of each node; parents stand before their children."""
    p = np.clip(p, 1e-6, 1 - 1e-6)
    with_text, without = np.log(p).tolist(), np.log(1 - p).tolist()
    n = len(with_text)
    up = parent.tolist()
    gain = [0.0] * n  # of the children that are better off with main text
    least: list[float | None] = [None] * n  # the smallest loss of a child, where none is
    some = [False] * n
    for i in range(n - 1, -1, -1):
        with_text[i] += gain[i] if some[i] else gain[i] + (least[i] or 0.0)
        j = up[i]
        if j >= 0:
            without[j] += without[i]
            more = with_text[i] - without[i]
            gain[j] += without[i] + (more if more > 0 else 0.0)
            some[j] = some[j] or more > 0
            if least[j] is None or more > least[j]:
                least[j] = more
    label = np.zeros(n, bool)
    needs = [False] * n
    for i in range(n):
        more = with_text[i] - without[i]
        j = up[i]
        if j < 0:
            label[i] = more > 0
        elif label[j]:
            if some[j]:
                label[i] = more > 0
            elif not needs[j] and more == least[j]:
                label[i] = needs[j] = True
    return label


def layout(rng: random.Random, texts: list[str]) -> str:
    """A page composed of sampled texts, with ``MARK`` before what is main text."""
    esc = lambda s: html.escape(s, quote=False)
    words = lambda a, b: esc(" ".join(rng.choice(texts).split()[: rng.randint(a, b)]) or "x")

    def prose(a: int = 1, b: int = 4) -> str:
        text = " ".join(rng.choice(texts) for _ in range(rng.randint(a, b)))
        return esc(text if rng.random() < 0.7 else " ".join(text.split()[: rng.randint(1, 40)]) or "x")

    def wrap(tags: str, roles: str, inner: str, plain: float = 0.1) -> str:
        """An element that says what it is by its tag, by a word, by both or not at all."""
        tag, word = rng.choice(tags.split()), rng.choice(roles.split())
        kind = rng.random()
        word = rng.choice([word, f"{word}-{rng.choice(['wrap', 'box', 'area', 'block', 'inner', 'list', '1'])}", f"site-{word}", f"{word}Container", f"{rng.choice(['l', 'c', 'js'])}-{word}"])
        if kind < plain:
            return f"<div>{inner}</div>"
        if kind < 0.4 and tag in TELLING:
            return f"<{tag}>{inner}</{tag}>"
        return f'<{tag if kind < 0.7 else "div"} {rng.choice(["class", "id", "role", "class"])}="{word}">{inner}</{tag if kind < 0.7 else "div"}>'

    def links(a: int, b: int) -> str:
        many = [f'<a href="/{i}">{words(1, 4)}</a>' for i in range(rng.randint(a, b))]
        return rng.choice([f"<ul>{''.join(f'<li>{x}</li>' for x in many)}</ul>", " | ".join(many), "".join(f"<p>{x}</p>" for x in many), " ".join(many)])

    def sentence() -> str:
        return prose(1, 1) if rng.random() < 0.6 else words(3, 20) + rng.choice(["", "."])

    def boiler(kind: str) -> str:
        text = rng.choice([lambda: f"<p>{sentence()}</p>", sentence, lambda: f"<h3>{words(1, 4)}</h3><p>{sentence()}</p>", lambda: f"<div>{sentence()}</div>"])
        if kind == "menu":
            return wrap("nav nav ul div", ROLES["menu"], links(2, 14))
        if kind == "header":
            return wrap("header header div", ROLES["header"], rng.choice([words(1, 4), f"<h1>{words(1, 4)}</h1><p>{words(2, 8)}</p>", f"<p>{words(2, 8)}</p>" + links(1, 6), sentence()]), 0.0)
        if kind == "footer":
            return wrap("footer footer div", ROLES["footer"], rng.choice([f"&copy; {words(1, 3)} &middot; {sentence()}", links(2, 8) + f"<p>&copy; {words(1, 6)}</p>", text()]), 0.0)
        if kind == "side":
            inner = "".join(f"<{'h3' if rng.random() < 0.5 else 'h2'}>{words(1, 4)}</h3>" + (links(2, 8) if rng.random() < 0.6 else text()) for _ in range(rng.randint(1, 3)))
            return wrap("aside aside section div", ROLES["side"], inner, 0.0)
        if kind == "notice":
            return wrap("div section aside p", ROLES["notice"], text() + rng.choice(["", "<button>ok</button>", f'<a href="#">{words(1, 2)}</a>']), 0.0)
        if kind == "advert":
            return wrap("div aside section", ROLES["advert"], rng.choice([text, lambda: f'<a href="#">{sentence()}</a>', sentence])(), 0.0)
        if kind == "form":
            return wrap("form form form div", ROLES["form"], f"<label>{words(1, 5)}</label><input name=q>" + rng.choice(["", f"<p>{sentence()}</p>"]) + f"<button>{words(1, 2)}</button>", 0.3)
        if kind == "share":
            return wrap("div p ul", "share sharing social follow tags toolbar", links(2, 6), 0.0)
        if kind == "hidden":
            return f"<div {rng.choice(['hidden', 'style=display:none', 'aria-hidden=true'])}>{text()}</div>"
        one = lambda: rng.choice(["<div class=comment>{}</div>", "<li class=comment>{}</li>", "<article class=comment>{}</article>", "<div class=reply><p>{}</p></div>", "<p>{}</p>", "<blockquote>{}</blockquote>"]).format(rng.choice(["", f"<b>{words(1, 2)}</b>: ", f"<h4>{words(1, 2)}</h4>"]) + prose(1, 2))
        inner = rng.choice(["", f"<h2>{words(1, 3)}</h2>", f"<h3>{words(1, 3)}</h3>"]) + "".join(one() for _ in range(rng.randint(1, 7)))
        return wrap("section div ol ul aside", ROLES["comment"], inner + (boiler("form") if rng.random() < 0.3 else ""), 0.0)

    def inline(text: str) -> str:
        parts = text.split()
        for _ in range(rng.randint(0, 2)):
            i = rng.randrange(len(parts))
            tag = rng.choice(["b", "i", "em", "strong", "span", 'a href="/x"', "code"])
            parts[i] = f"<{tag}>{parts[i]}</{tag.split()[0]}>"
        return " ".join(parts)

    def main_block() -> str:
        kind = rng.random()
        if kind < 0.74:
            return f"<p>{MARK}{inline(prose())}" + ("</p>" if rng.random() < 0.9 else "")
        if kind < 0.80:
            return f"<h{rng.randint(2, 4)}>{MARK}{words(1, 8)}</h2>"
        if kind < 0.86:
            return rng.choice(["<ul>{}</ul>", "<ol>{}</ol>"]).format("".join(f"<li>{MARK}{rng.choice([sentence(), words(1, 6)])}</li>" for _ in range(rng.randint(2, 6))))
        if kind < 0.89:
            return f"<blockquote>{MARK}{prose(1, 2)}</blockquote>"
        if kind < 0.91:
            return f"<figure><img src=x><figcaption>{MARK}{words(3, 14)}</figcaption></figure>"
        if kind < 0.93:
            return "<table>" + "".join("<tr>" + "".join(f"<td>{MARK}{words(1, 4)}</td>" for _ in range(3)) + "</tr>" for _ in range(rng.randint(1, 4))) + "</table>"
        if kind < 0.96:
            return f"<p>{MARK}<b>{prose(1, 1)}<br>"
        return f"<div>{MARK}{prose(1, 2)}</div>" if kind < 0.98 else f"{MARK}{prose(1, 1)}"

    title = rng.choice(["", f"<h1>{MARK}{words(2, 12)}</h1>", f"<h1>{MARK}{words(2, 12)}</h1>", f"<h2>{MARK}{words(2, 12)}</h2>"])
    within = ["notice", "advert", "side", "share", "form", "menu", "hidden"]
    blocks = [main_block() for _ in range(rng.choice([1, 1, 2, 3, 4, 6, 9, 14]))]
    if title and rng.random() < 0.1:
        title = f"<header>{title}</header>"
    if rng.random() < 0.1:
        blocks.append("</p>" + boiler("comment"))
    for _ in range(rng.choice([0, 0, 0, 1, 2])):
        blocks.insert(rng.randrange(len(blocks) + 1), "</p>" + boiler(rng.choice(within)))
    inner = title + "".join(blocks)
    main = wrap("article article main div section", ROLES["main"].replace("page", "post"), inner, 0.25) if rng.random() < 0.93 else f"<p>{inner}"
    for _ in range(rng.choice([0, 0, 1, 2, 3])):
        around = [boiler(rng.choice(["advert", "side", "comment", "share", "notice"])) if rng.random() < 0.3 else "" for _ in range(2)]
        main = f"<{rng.choice(['div', 'div class=container', 'div id=wrapper', 'main', 'div class=row', 'section', 'div class=page', 'div id=main', 'div class=content'])}>{around[0]}{main}{around[1]}</div>"
    first = [boiler(k) for k in rng.sample(["menu", "header", "notice", "advert", "form", "side", "hidden"], rng.randint(0, 4))]
    last = [boiler(k) for k in rng.sample(["footer", "comment", "side", "advert", "menu", "notice", "form", "share"], rng.randint(0, 5))]
    if rng.random() < 0.08:  # a page without an article
        main = ""
    body = "".join(first) + main + "".join(last)
    if rng.random() < 0.06:  # nothing but an article, or just its text
        body = rng.choice([inner, f"<p>{MARK}{prose()}", f"{MARK}{prose(1, 2)}"])
    return f"<html><body>{body}</body></html>" if rng.random() < 0.8 else body


def truth(table: Table, main: np.ndarray) -> np.ndarray:
    """Whether main text lies in a node, given the leaves that are main text."""
    label = main.copy()
    for i in range(len(label) - 1, -1, -1):
        if label[i] and table.parent[i] >= 0:
            label[table.parent[i]] = True
    return label


def training_rows(pages: list[str], texts: list[str], composed: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the nodes of composed pages, and of the given ones that say
    themselves what their article is."""
    rng = random.Random(seed)
    drawn = Nodes()
    for _ in range(composed if texts else 0):
        read_page(layout(rng, texts), drawn)
    main = [MARK in t for t in drawn.text]
    drawn.text = [t.replace(MARK, "").strip() for t in drawn.text]
    given = Nodes()
    for page in pages:
        read_page(page, given)
    xs, ys = [], []
    if drawn.tag:
        table = node_table(drawn)
        # Texts keep their order, so the leaves of the table are the marked runs in turn.
        leaves = np.array([bool(t) for t in table.text])
        flags = np.zeros(len(leaves), bool)
        flags[leaves] = [m for m, t in zip(main, drawn.text) if t]
        xs.append(table.x), ys.append(truth(table, flags))
    if given.tag:
        table = node_table(given)
        around, tags = (np.array(x) | np.array(y) for x, y in ((given.above, given.own), (given.within, [1 << t for t in given.tag])))
        shown = (tags & MAIN_TAGS > 0) & (tags & BOILER_TAGS == 0) & (around & BOILER_ROLES == 0)
        leaves = np.array([bool(t) for t in table.text])
        flags = np.zeros(len(leaves), bool)
        flags[leaves] = [shown[i] for i, t in enumerate(given.text) if t]
        has = truth(table, flags)
        page = np.searchsorted(np.sort(table.root[table.root >= 0]), np.arange(len(has)), "right") - 1
        known = has[np.sort(table.root[table.root >= 0])][page] if len(has) else has
        xs.append(table.x[known]), ys.append(has[known])
    if not xs:
        return np.empty((0, 1), np.float32), np.empty(0)
    return np.concatenate(xs), np.concatenate(ys).astype(float)


def fit(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE_PAGES, composed: int = COMPOSED) -> Trees:
    """Learn from a bounded sample of the pages."""
    rows = pages.select(F.col(f"`{html_col}`").cast("string").alias("html"), F.col(f"`{id_col}`").cast("string").alias("id")).where("html <> ''")
    chosen = bounded_sample(rows, F.xxhash64("id", "html"), sample)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list] = ([], [])
            for page in batch.column("html").to_pylist():
                nodes = Nodes()
                read_page(page, nodes)
                found = sorted((t for t in nodes.text if t), key=lambda t: (-len(t), t))
                out[0].append([t[:RUN_CHARS] for t in found[:RUNS_PER_PAGE]])
                out[1].append(page if len(page) <= 20 * RUN_CHARS else None)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.list_(pa.string())), pa.array(out[1], pa.string())], names=["runs", "page"])

    found = chosen.mapInArrow(runs, "runs array<string>, page string").limit(2 * sample).toArrow().to_pylist()
    found.sort(key=lambda r: (r["runs"], r["page"] or ""))
    texts = [t for r in found for t in r["runs"]]
    # Sentences of a text rather than whole texts: articles are put together from them.
    texts = [s.strip() for t in texts for s in re.split(r"(?<=[.!?]) ", t) if s.strip()]
    x, y = training_rows([r["page"] for r in found if r["page"]], texts, composed)
    return fit_trees(x, y)


def extract(pages: DataFrame, model: Trees, *, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``keep``, all by default), ``text`` and ``n_chars``."""
    payload, pages_of = carried(pages, html_col, keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = pages_of(batch)
            for a in range(0, batch.num_rows, ROWS_AT_ONCE):
                found = texts_of(column.slice(a, ROWS_AT_ONCE).to_pylist(), model)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(a, ROWS_AT_ONCE), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                    names=["row", "text", "n_chars"],
                )

    return payload.mapInArrow(run, payload.select("row").schema.add("text", "string").add("n_chars", "long"))


def texts_of(pages: list[str | None], model: Trees) -> list[str]:
    """The main texts of some pages."""
    nodes = Nodes()
    for page in pages:
        read_page(page or "", nodes)
    table = node_table(nodes)
    label = decode(table.parent, model.scores(table.x)) if len(table.x) and len(model.feature) else np.zeros(len(table.x), bool)
    bounds = np.append(np.where(table.root >= 0, table.root, 0), len(table.x))
    out, end = [], len(table.x)
    for root in table.root[::-1]:
        if root < 0:
            out.append("")
            continue
        out.append("\n".join(table.text[i] for i in range(root, end) if label[i] and table.text[i]))
        end = root
    return out[::-1]
