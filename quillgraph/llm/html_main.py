"""Main text of web pages: boosted trees over DOM-node features, decoded along the tree.

Every block element of a page is a node.  Trees score how likely a node's text
is part of the article, from the node's tag, attribute words, text and link
density of its subtree, depth, place among its siblings, and ancestors.  The
labels of a page are then chosen together: a node is *in* the article, *out*
of it, or *mixed*; below *out* all is out, below *in* nothing is mixed, and the
labelling of most likelihood is found bottom-up, so no descendant contradicts an
ancestor.  The trees are trained on pages that ``training_page`` composes, whose
article is known; how many is ``TRAINING_PAGES``.
"""

from __future__ import annotations

import html
import math
import random
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillgraph.llm.boosting import BoostedTrees, fit
from quillgraph.llm.common import arrow_map

#: Labelled pages that the trees are fitted to (bounded), and their seed.
TRAINING_PAGES, SEED = 500, 11
#: Elements that hold text apart from what stands around them (fixed values of HTML).
BLOCKS = frozenset("html body main article section div p ul ol li dl dt dd table thead tbody tfoot tr td th caption h1 h2 h3 h4 h5 h6 header footer nav aside form fieldset blockquote pre figure figcaption address details summary dialog menu hgroup center noscript title head template iframe".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
#: Their content is no text of the page.
RAW = ("script", "style", "textarea")
HIDDEN = frozenset("head title noscript template iframe select option button svg".split())
#: A start tag of these ends an open p; li, dt, dd, tr, td, th and option end one of their kind.
_ENDS_P = BLOCKS - frozenset("html head body title noscript template iframe td th tr thead tbody tfoot caption".split())
_PEERS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select",)}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)|<", re.DOTALL)
_ATTRIBUTE = re.compile(r"(?:class|id|role|itemprop|aria-label|hidden)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")
_ENDS = re.compile(r"[.!?,;:]")


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    depth: int
    place: int  # among its siblings
    words: tuple[str, ...]
    text: list[tuple[int, str]] = field(default_factory=list)  # (turn, text) directly in it
    links: int = 0  # characters of its own text inside links
    children: list[int] = field(default_factory=list)


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """The block nodes of a page, parents first, and its blocks of text (node, text) in page order."""
    nodes = [Node("html", -1, 0, 0, ())]
    stack: list[tuple[str, int]] = [("html", 0)]  # every open element, and the block it stands in
    blocks: list[tuple[int, str]] = []
    parts: list[str] = []
    here = 0
    in_link = in_hidden = 0
    at = 0

    def flush() -> None:
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                blocks.append((here, text))
            parts.clear()

    def close(to: int) -> None:
        nonlocal here, in_link, in_hidden
        while len(stack) > to:
            tag, _ = stack.pop()
            if tag in BLOCKS:
                flush()
            in_link -= tag == "a"
            in_hidden -= tag in HIDDEN
        here = stack[-1][1]

    def add(text: str) -> None:
        if text and not in_hidden:
            parts.append(text)
            if in_link:
                nodes[here].links += len(text)

    for token in _TOKEN.finditer(page):
        add(page[at : token.start()])
        if token.start() < at:
            continue
        at = token.end()
        name = token[2]
        if name is None:
            if token[0] == "<":
                add("<")
            continue
        tag = name.lower()
        if token[1]:
            if tag == "br":
                add(" ")
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
            continue
        if tag in VOID:
            if tag in ("br", "hr", "img"):
                add(" ")
            if tag == "hr":
                flush()
            continue
        if tag in RAW or tag == "xmp":
            begin = at
            end = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            if tag == "xmp":  # its text stands as it is, without tags or references
                flush()
                add(html.escape(page[begin : end.start() if end else len(page)], quote=False))
                flush()
            continue
        if tag in ("html", "body") and any(t == tag for t, _ in stack[1:]) or tag == "html":
            continue
        if tag in _ENDS_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    close(k)
                    break
                if stack[k][0] in BLOCKS:
                    break
        if tag in _PEERS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in _PEERS[tag]:
                    close(k)
                    break
                if stack[k][0] in _SCOPES[tag]:
                    break
        if tag == "body":  # what was left open in the head ends
            close(1)
        if tag in BLOCKS:
            flush()
            words = tuple(w.lower() for m in _ATTRIBUTE.finditer(token[3]) for w in _WORD.findall(m[1] or m[2] or m[3] or "")) if token[3] else ()
            parent = nodes[here]
            nodes.append(Node(tag, here, parent.depth + 1, len(parent.children), words))
            parent.children.append(len(nodes) - 1)
            here = len(nodes) - 1
        stack.append((tag, here))
        in_link += tag == "a"
        in_hidden += tag in HIDDEN
    add(page[at:])
    close(1)
    flush()
    return nodes, blocks


_TAGS = ("article", "main", "section", "div", "p", "li", "ul", "nav", "aside", "header", "footer", "form", "table", "td", "blockquote", "pre", "h1", "h2", "figure", "dialog")
_ABOVE = ("article", "main", "nav", "aside", "header", "footer", "form", "ul", "table")
FEATURES = [*(f"is_{t}" for t in _TAGS), *(f"in_{t}" for t in _ABOVE), "words_own", "words_least", "words_most", "depth", "place", "siblings", "same_tag", "own_text", "all_text", "share", "link_share", "tags_per_text", "ends_per_word", "mean_block", "n_blocks", "before", "first_block", "holds_h1", "holds_p", "holds_li"]


def features(nodes: list[Node], blocks: list[tuple[int, str]], said: dict[str, float]) -> np.ndarray:
    """A row for each node; ``said``: how strongly an attribute word speaks for the article."""
    n = len(nodes)
    own, n_blocks, ends, words = [0] * n, [0] * n, [0] * n, [0] * n
    first: list[int] = [10**9] * n
    for turn, (node, text) in enumerate(blocks):
        own[node] += len(text)
        n_blocks[node] += 1
        ends[node] += len(_ENDS.findall(text))
        words[node] += text.count(" ") + 1
        first[node] = min(first[node], turn)
    total, links, inner = own[:], [min(x.links, 10**9) for x in nodes], [1] * n
    holds = [[x.tag == "h1", x.tag == "p", x.tag == "li"] for x in nodes]
    for i in range(n - 1, 0, -1):
        p = nodes[i].parent
        total[p] += total[i]
        links[p] += links[i]
        inner[p] += inner[i]
        n_blocks[p] += n_blocks[i]
        ends[p] += ends[i]
        words[p] += words[i]
        first[p] = min(first[p], first[i])
        for k in range(3):
            holds[p][k] += holds[i][k]
    every, turns = max(1, total[0]), max(1, len(blocks))
    above: list[frozenset] = [frozenset()] * n
    least, most = [0.0] * n, [0.0] * n
    rows = np.zeros((n, len(FEATURES)))
    peers: dict[tuple[int, str], int] = {}
    for x in nodes:
        peers[x.parent, x.tag] = peers.get((x.parent, x.tag), 0) + 1
    at = len(_TAGS) + len(_ABOVE)
    for i, x in enumerate(nodes):
        mine = sum(said.get(w, 0.0) for w in x.words)
        if x.parent >= 0:
            up = x.parent
            above[i] = above[up] | {nodes[up].tag}
            least[i], most[i] = min(mine, least[up]), max(mine, most[up])
        else:
            least[i], most[i] = min(mine, 0), max(mine, 0)
        row = rows[i]
        if x.tag in _TAG_AT:
            row[_TAG_AT[x.tag]] = 1
        for tag in above[i]:
            if tag in _ABOVE_AT:
                row[_ABOVE_AT[tag]] = 1
        siblings = len(nodes[x.parent].children) if x.parent >= 0 else 1
        blocks_in = max(1, n_blocks[i])
        row[at:] = (mine, least[i], most[i], x.depth, x.place / siblings, siblings, peers[x.parent, x.tag] / siblings, math.log1p(own[i]), math.log1p(total[i]), total[i] / every, links[i] / max(1, total[i]), inner[i] / max(1, total[i]), ends[i] / max(1, words[i]), math.log1p(total[i] / blocks_in), math.log1p(n_blocks[i]), min(first[i], turns) / turns, first[i] == 0, holds[i][0], math.log1p(holds[i][1]), math.log1p(holds[i][2]))
    return rows


_TAG_AT = {t: i for i, t in enumerate(_TAGS)}
_ABOVE_AT = {t: len(_TAGS) + i for i, t in enumerate(_ABOVE)}


def decode(nodes: list[Node], blocks: list[tuple[int, str]], odds: np.ndarray) -> list[bool]:
    """Which blocks are of the article, by the labelling of most likelihood that the tree allows."""
    n = len(nodes)
    own = [0] * n
    for node, text in blocks:
        own[node] += 1
    log_in, log_out = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
    mixed_cost = math.log(0.4)
    # a node without text of its own says less: its children speak for it
    weight = [1.0 if c else 0.3 for c in own]
    score = [[w * a, w * b, mixed_cost if not c else min(mixed_cost, b)] for w, a, b, c in zip(weight, log_in.tolist(), log_out.tolist(), own, strict=True)]
    choice: list[tuple[int, int, int] | None] = [None] * n
    for i in range(n - 1, 0, -1):
        s_in, s_out, s_mix = score[i]
        under_in = 0 if s_in >= s_out else 1
        under_mix = max((0, 1, 2), key=lambda k: score[i][k])
        choice[i] = (under_in, 1, under_mix)
        up = score[nodes[i].parent]
        up[0] += max(s_in, s_out)
        up[1] += s_out
        up[2] += max(s_in, s_out, s_mix)
    label = [2] * n
    label[0] = max((0, 1, 2), key=lambda k: score[0][k])
    for i in range(1, n):
        label[i] = choice[i][label[nodes[i].parent]]
    return [label[node] == 0 for node, _ in blocks]


@dataclass
class Extractor:
    said: dict[str, float]
    trees: BoostedTrees

    def texts(self, pages: list[str]) -> list[str]:
        parsed = [parse(p) for p in pages]
        rows = [features(nodes, blocks, self.said) for nodes, blocks in parsed]
        odds = self.trees.log_odds(np.concatenate(rows)) if rows else np.zeros(0)
        out, at = [], 0
        for (nodes, blocks), row in zip(parsed, rows, strict=True):
            kept = decode(nodes, blocks, odds[at : at + len(row)])
            at += len(row)
            out.append("\n".join(text for (_, text), keep in zip(blocks, kept, strict=True) if keep))
        return out


# Training pages. Words of class and id attributes that pages commonly use (fixed values, for composing pages).
_MAIN = "article content post entry story main body text page single detail blog news prose read copy".split()
_CHROME = {
    "nav": "nav navbar navigation menu topnav breadcrumb breadcrumbs links site-links tabs".split(),
    "header": "header masthead banner top site-header branding logo".split(),
    "footer": "footer site-footer copyright bottom legal colophon credits".split(),
    "aside": "sidebar aside related widget rail recommended popular trending more-stories secondary".split(),
    "ad": "ad ads advert advertisement sponsored promo banner-ad sponsor dfp adsense commercial".split(),
    "notice": "cookie cookies consent notice alert gdpr popup modal overlay newsletter subscribe-notice paywall".split(),
    "form": "form subscribe newsletter signup search login contact-form".split(),
    "comments": "comments comment replies disqus discussion responses comment-list reader-comments".split(),
    "share": "share social sharing tags author-box meta toolbar follow".split(),
}
_SYLLABLES = "an the ber con di er fa go hi in ja ko la mi no or pe qua ri sta ti un ve wo xi ya zo ing ed ly tion ment".split()


def training_page(r: random.Random) -> tuple[str, set[str]]:
    """A page, and the blocks of text of its article; every block of a page is unlike the others."""
    used: set[str] = set()

    def words(a: int, b: int) -> str:
        while True:
            out = [("".join(r.choice(_SYLLABLES) for _ in range(r.randint(1, 4)))) for _ in range(r.randint(a, b))]
            if r.random() < 0.8:
                out = [w + ("," if r.random() < 0.08 else ".") if r.random() < 0.12 else w for w in out]
                out[-1] += "."
            text = " ".join(out).capitalize()
            if text not in used:
                used.add(text)
                return text

    def attribute(kind: list[str]) -> str:
        x = r.random()
        if x < 0.2:
            return ""
        name = r.choice(kind) + r.choice(["", "", "", "-wrap", "-inner", "_box", "-list", "1"])
        return f' {r.choice(["class", "class", "id"])}="{name}{" " + r.choice(["clearfix", "row", "col", "box", "block", "wide"]) if r.random() < 0.3 else ""}"'

    def links(n: int, short: bool = True) -> str:
        items = [f'<li><a href="/{i}">{words(1, 4) if short else words(3, 14)}</a></li>' for i in range(n)]
        return f"<ul>{''.join(items)}</ul>" if r.random() < 0.85 else "".join(f'<a href="/{i}">{words(1, 3)}</a> ' for i in range(n))

    def chrome(kind: str) -> str:
        natural = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form", "comments": "section"}
        tag = natural[kind] if kind in natural and r.random() < 0.7 else "div"
        mark = attribute(_CHROME[kind]) if tag != "div" else attribute(_CHROME[kind]) or f' class="{r.choice(_CHROME[kind])}"'
        if kind == "nav":
            body = links(r.randint(2, 9))
        elif kind == "header":
            body = r.choice([f"<h1>{words(1, 4)}</h1>", f"<p>{words(2, 9)}</p>", f"<div>{words(1, 5)}</div>", words(1, 6)]) + (links(r.randint(2, 6)) if r.random() < 0.4 else "")
        elif kind == "footer":
            body = r.choice(["&copy; ", "", "Copyright 2021 "]) + words(2, 14) + (f"<p>{words(3, 30)}</p>" if r.random() < 0.4 else "") + (links(r.randint(2, 6)) if r.random() < 0.4 else "")
        elif kind == "aside":
            body = f"<h{r.choice('234')}>{words(1, 4)}</h3>" + r.choice([links(r.randint(2, 7), False), "".join(f"<p>{words(5, 40)}</p>" for _ in range(r.randint(1, 3)))])
        elif kind == "ad":
            body = r.choice([words(2, 25), f"<p>{words(4, 30)}</p>", f'<a href="/x">{words(3, 15)}</a>', f"<span>{words(3, 12)}</span>"])
        elif kind == "notice":
            body = r.choice([words(6, 40), f"<p>{words(6, 40)}</p>"]) + (f"<button>{words(1, 2)}</button>" if r.random() < 0.6 else "")
        elif kind == "form":
            body = f"<label>{words(1, 5)}</label><input name=q>" + (f"<p>{words(4, 20)}</p>" if r.random() < 0.5 else "") + f"<button>{words(1, 2)}</button>"
        elif kind == "comments":
            one = lambda: f'<{(t := r.choice(["div", "li", "article", "p"]))}{attribute(["comment", "reply", "comment-body"])}>' + (f"<b>{words(1, 2)}</b>" if r.random() < 0.4 else "") + (f"<p>{words(4, 50)}</p>" if t != "p" else words(4, 50)) + f"</{t}>"
            body = (f"<h3>{words(1, 3)}</h3>" if r.random() < 0.7 else "") + "".join(one() for _ in range(r.randint(1, 6)))
        else:
            body = r.choice([links(r.randint(2, 5)), f"<span>{words(1, 6)}</span>"])
        return f"<{tag}{mark}>{body}</{tag}>"

    main: list[str] = []

    def keep(text: str) -> str:
        main.append(text)
        return text

    def paragraph() -> str:
        x = r.random()
        text = keep(words(1, 4) if r.random() < 0.12 else words(6, 120))
        if x < 0.6:
            return f"<p>{text}</p>"
        if x < 0.7:
            return f"<p><b>{text}<br>"  # left open
        if x < 0.76:
            return f"<p>{text}"
        if x < 0.82:
            return f"<h{(n := r.choice('2345'))}>{text}</h{n}>"
        if x < 0.88:
            return f"<ul><li>{text}</li><li>{keep(words(4, 40))}</li></ul>"
        if x < 0.92:
            return f"<blockquote><p>{text}</p></blockquote>"
        if x < 0.95:
            return f"<table><tr><td>{text}</td><td>{keep(words(1, 9))}</td></tr></table>"
        if x < 0.97:
            return f"<pre>{text}</pre>"
        return f"<div>{text}</div>"

    inside = [f"<h1>{keep(words(2, 14))}</h1>" if r.random() < 0.85 else ""]
    for _ in range(r.choice([1, 2, 3, 4, 6, 9, 14, 20])):
        inside.append(paragraph())
        if r.random() < 0.06:
            inside.append(chrome(r.choice(["ad", "share", "notice", "aside", "form"])))
    if r.random() < 0.25:
        inside.append(chrome(r.choice(["share", "comments", "ad", "aside"])))
    style = r.random()
    if style < 0.5:
        body = f"<article{attribute(_MAIN)}>{''.join(inside)}</article>"
    elif style < 0.65:
        body = f"<main{attribute(_MAIN)}>{''.join(inside)}</main>"
    else:
        body = f'<div {r.choice(["class", "id"])}="{r.choice(_MAIN)}{r.choice(["", "-body", "-content", "-wrap"])}">{"".join(inside)}</div>'
    if r.random() < 0.3:
        body = f"<main>{body}{chrome('comments') if r.random() < 0.4 else ''}</main>"
    before = [chrome(k) for k in ("notice", "header", "nav", "nav", "ad", "form") if r.random() < 0.45]
    after = [chrome(k) for k in ("aside", "comments", "ad", "share", "footer", "notice", "footer") if r.random() < 0.4]
    if r.random() < 0.15:
        before.append(chrome("aside"))
    page = "".join([*before, body, *after])
    if r.random() < 0.4:
        page = f'<div class="{r.choice(["wrapper", "container", "page", "site"])}">{page}</div>'
    head = f"<head><meta charset=utf-8><title>{words(2, 8)}</title><style>p{{margin:0}}</style><script>var a='<p>';</script></head>"
    return f"<!DOCTYPE html><html>{head}<body>{page}</body></html>", set(main)


def trained(pages: int = TRAINING_PAGES, seed: int = SEED) -> Extractor:
    """Fit the attribute words' weights and the trees to composed pages; the same for the same numbers."""
    r = random.Random(seed)
    parsed = []
    for _ in range(pages):
        page, main = training_page(r)
        nodes, blocks = parse(page)
        good, every = [0] * len(nodes), [0] * len(nodes)
        for node, text in blocks:
            every[node] += len(text)
            good[node] += len(text) * (text in main)
        for i in range(len(nodes) - 1, 0, -1):
            every[nodes[i].parent] += every[i]
            good[nodes[i].parent] += good[i]
        parsed.append((nodes, blocks, good, every))
    for_main: dict[str, list[float]] = {}
    for nodes, _, good, every in parsed:
        for x, g, e in zip(nodes, good, every, strict=True):
            for w in set(x.words) if e else ():
                count = for_main.setdefault(w, [1.0, 1.0])
                count[0] += g / e
                count[1] += 1 - g / e
    said = {w: math.log(a / b) for w, (a, b) in for_main.items() if a + b >= 6}
    x = np.concatenate([features(nodes, blocks, said) for nodes, blocks, _, _ in parsed])
    good, every = (np.array([v for p in parsed for v in p[k]], float) for k in (2, 3))
    some = every > 0
    return Extractor(said, fit(x[some], (good[some] / every[some] > 0.5).astype(float), np.ones(int(some.sum()))))


_models: dict[tuple[int, int], Extractor] = {}


def extracted(pages: DataFrame, training_pages: int = TRAINING_PAGES, seed: int = SEED) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row: the article's blocks, joined by line feeds.

    Character references are decoded, white space within a block becomes one
    space, and nothing else is dropped or cut.  A null or empty page, and one
    without an article, has an empty text; nulls in other columns stay, further
    columns are dropped, and an empty table gives no rows.  A map without a
    shuffle; the trained model, of a fixed size, is sent to the workers.
    """
    if (training_pages, seed) not in _models:
        _models[training_pages, seed] = trained(training_pages, seed)
    sent = pages.sparkSession.sparkContext.broadcast(_models[training_pages, seed])

    def make():
        model = sent.value

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts: list[str] = []
            source = [p or "" for p in batch.column("html").to_pylist()]
            for at in range(0, len(source), 64):
                texts += model.texts(source[at : at + 64])
            return pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

        return one

    return arrow_map(pages.select("page_id", "url", "html"), make, "page_id long, url string, text string, n_chars long")
