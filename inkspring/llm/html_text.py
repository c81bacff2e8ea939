"""Main text of HTML pages by a maximum-scoring subsequence.

A page is a sequence of words and tags. Words score by the log-odds of standing in content: weights for the elements
around them (tags, and the words of class, id and role, nearer elements counting more), for links, for the length of
their block, for standing beside the page's article and for standing in its main container add up, and no single one
decides. Tags score negative, the more the rarer they are in content. One linear scan (Kadane's) finds the contiguous
run of tokens with the largest sum: the content region. Names of elements that stand around the whole main container tell
nothing of one part against another, so they do not count in the final scores. Text in the container that something
speaks against (an advert between two paragraphs) does not end the region, but is left out if its own log-odds are low
enough, the lower the longer its block; the rest is cut into blocks.

The weights are fitted by logistic regression on labelled pages: whole pages of many layouts, made by a seeded
generator (a list of fixed size on the driver), with names that tell nothing as well as names that do. Pages are handled
one by one where they lie, whole, with no shuffle.

Defined cases: a null page is an empty one, an empty table gives an empty result; pages of any length are read whole, in
memory in proportion to their own length; a page whose best sum is not positive has an empty text; unclosed tags,
comments, scripts and quotes end with the page; repeated rows are answered alike; equal sums: the earlier, shorter
region wins; of equal containers the first is the main one; extra columns are not read, whatever their names.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_map

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|title|svg|select|button|object|canvas|audio|video|math)(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?:(?<=/)>|>.*?(?:</(?P=raw)\s*>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)|<[a-zA-Z][^<>]*+(?:>|\Z)",
    re.S | re.I,
)
_NAMED = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)

# Elements of HTML.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Blocks that hold a paragraph's words; the others are boxes.
_LINES = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt figcaption figure summary table tbody tfoot thead tr ul ol dl".split())
_LISTS = frozenset("ul ol dl menu".split())

# Words that name parts of a page in classes and ids, for the labelled pages.
PARTS_OUT = (
    "nav navbar navigation menu header masthead topbar footer sidebar aside rail widget ad ads advert advertisement banner promo sponsor sponsored outbrain taboola teaser cookie cookies consent gdpr notice alert popup modal overlay sticky "
    "newsletter subscribe signup login form search comment comments reply replies respond discussion disqus kommentar kommentare commentaires comentarios werbung anzeige publicidad publicite hinweis aviso related recommended recommendations share sharing social "
    "breadcrumb breadcrumbs pagination pager tags toolbar toc copyright legal imprint disclaimer skip"
).split()
PARTS_IN = "content main article post entry story body text prose page section inhalt contenu contenido artikel".split()
LAYOUT = "container wrapper outer inner row col grid layout wide left right clearfix site box block item group area panel slot unit zone holder bar list links buttons space top bottom".split()
#: Last words of the class of a box around everything.
OUTER = "layout page site wrapper container grid view app body root template theme".split()
#: First words of a class that tell of a part elsewhere (has-sidebar), not of the element.
STATES = frozenset("has have with without no is not show hide".split())


def labelled_pages(n: int = 1_000, seed: int = 5) -> list[list[tuple[str, bool]]]:
    """Whole pages, each a list of (html, content) pieces that follow each other."""
    rng = random.Random(seed)
    words = lambda lo, hi: " ".join(["word"] * rng.randint(lo, hi))
    link = lambda: f"<a href='/x'>{words(1, 4)}</a>"
    says = lambda: words(6, 25) + "."

    def stuff(kind: int) -> str:
        """The inside of a part that is not content."""
        if kind == 0:
            return "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(rng.randint(2, 9))) + "</ul>"
        if kind == 1:
            return rng.choice([says(), f"<p>{says()}</p>", f"<p>{says()}</p><p>{says()}</p>", f"<h3>{words(1, 4)}</h3><p>{says()} {link()}</p>", f"<p>{words(20, 60)}.</p>"])
        if kind == 2:
            return f"<form><label>{words(1, 3)}</label><input name=q><p>{words(2, 12)}</p></form>"
        if kind == 3:
            return "".join(f"<div class='{rng.choice(['comment', 'reply', 'item', ''])}'><b>{words(1, 2)}</b><p>{words(5, 60)}</p></div>" for _ in range(rng.randint(1, 5)))
        if kind == 4:
            return "".join(f"<article><h4>{link()}</h4><p>{words(3, 30)}</p></article>" for _ in range(rng.randint(1, 4)))
        return f"{link()} | {link()} {words(0, 6)}"

    def noise(inner: bool) -> str:
        if rng.random() < 0.3:
            tag = rng.choice(["nav", "aside", "form", "menu", "dialog"] if inner else ["nav", "header", "footer", "aside", "form", "menu", "dialog"])
            return f"<{tag}>{stuff(rng.randint(0, 5))}</{tag}>"
        name = rng.choice(PARTS_OUT)
        if rng.random() < 0.4:
            name = rng.choice([f"{name}-{rng.choice(LAYOUT)}", f"{rng.choice(LAYOUT)}-{name}", f"{name} {rng.choice(LAYOUT)}", f"{name}-{rng.choice(PARTS_IN)}", f"{name}-{rng.choice(PARTS_OUT)}"])
        tag = rng.choice(["div", "div", "section", "ul" if rng.random() < 0.2 else "div"])
        said = stuff(3 if name.startswith(("comment", "repl", "discuss", "komm", "disq")) else rng.randint(0, 5))
        return f"<{tag} {rng.choice(['class', 'id'])}='{name}'>{said}</{tag}>"

    def block() -> str:
        k = rng.random()
        if k < 0.6:
            text = words(4, 70)
            if rng.random() < 0.3:
                text += f" {link()} <em>{words(1, 3)}</em> {words(2, 20)}"
            return f"<p>{text}.</p>" if rng.random() < 0.9 else f"<p><b>{words(2, 9)}<br>{text}"
        if k < 0.7:
            return f"<h2>{words(1, 8)}</h2>"
        if k < 0.78:
            return f"<{(t := rng.choice(['ul', 'ol']))}>" + "".join(f"<li>{words(1, 20) if rng.random() < 0.8 else link()}</li>" for _ in range(rng.randint(2, 5))) + f"</{t}>"
        if k < 0.84:
            return f"<blockquote>{words(4, 40)}</blockquote>"
        if k < 0.9:
            return f"<figure><img src=x><figcaption>{words(2, 12)}</figcaption></figure>"
        if k < 0.93:
            return f"<p>{rng.choice(['', f'{words(1, 3)}: '])}<a href='/x'>{words(2, 9)}</a>{rng.choice(['', '.', f' {words(1, 3)}.'])}</p>"
        if k < 0.97:
            return f"<p>{rng.choice([words(1, 4), link(), rng.choice(['All rights reserved.', f'&copy; 2020 {words(1, 6)}', f'Copyright {words(1, 6)}.'])])}</p>"
        return f"<table><tr><td>{words(1, 6)}</td><td>{words(1, 6)}</td></tr><tr><td>{words(1, 6)}</td><td>{words(1, 6)}</td></tr></table>"

    def around() -> str:
        """The class of a box around everything; what it is named after may be only one of its parts."""
        k = rng.random()
        return f"{rng.choice(LAYOUT)} {rng.choice(LAYOUT)}" if k < 0.5 else f"{rng.choice(PARTS_OUT + PARTS_IN)}-{rng.choice(OUTER)}" if k < 0.85 else f"{rng.choice(PARTS_IN)}-{rng.choice(LAYOUT)}"

    def made_up() -> str:
        return "".join(rng.choice(["ka", "lo", "mi", "ru", "te", "zo"]) for _ in range(3))

    def inner(piece: str) -> str:
        """A block of content; sometimes in a box that is named after its topic."""
        return f"<div class='{made_up()}-{rng.choice(PARTS_OUT)}'>{piece}</div>" if rng.random() < 0.18 else f"<div class='{made_up()}'>{piece}</div>" if rng.random() < 0.05 else piece

    pages = []
    for _ in range(n):
        out: list[tuple[str, bool]] = [(f"<!DOCTYPE html><html><head><title>{words(2, 9)}</title></head>", False)]
        tells = lambda: f" class='{rng.choice(['', 'has-', 'with-', 'no-', 'is-'])}{rng.choice(PARTS_OUT)} {rng.choice(LAYOUT)}'" if rng.random() < 0.5 else ""
        out.append((f"<body{tells()}>", False))
        ends = ["</body></html>"]
        if rng.random() < 0.15:
            out.append(("<form id='aspnetForm' action='/'><input type=hidden>", False))
            ends.append("</form>")
        for _ in range(rng.randint(0, 2)):
            out.append((f"<div class='{around()}'>", False))
            ends.append("</div>")
        out += [(noise(False), False) for _ in range(rng.randint(0, 4))]
        box = rng.choice(["article", "article", "main", "main", "div", "div", "div", "col", "table", "plain", "none"])
        if box in ("article", "main"):
            out.append((f"<{box}{tells()}>", False))
            close = f"</{box}>"
        elif box == "div":
            name = rng.choice(PARTS_IN)
            name = rng.choice([name, name, f"{name} {rng.choice(['with-', 'has-', 'no-', ''])}{rng.choice(PARTS_OUT)}-{rng.choice(LAYOUT)}", f"{rng.choice(LAYOUT)}-{name}", f"{name}-{rng.choice(LAYOUT)}"])
            beside = f" class='{rng.choice(PARTS_OUT)}-{rng.choice(LAYOUT)}'" if rng.random() < 0.3 else ""
            out.append((f"<{rng.choice(['div', 'section'])} id='{name}'{beside}>" if beside or rng.random() < 0.5 else f"<{rng.choice(['div', 'section'])} class='{name}'>", False))
            close = "</div></section>"
        elif box == "col":
            name = rng.choice(["main-col", "col-8", "left-col", "col", "main", f"{made_up()}-{rng.choice(LAYOUT)}", f"{rng.choice(PARTS_OUT)}-{rng.choice(OUTER)}"])
            out.append((f"<div class='{around()}'><div class='{name}'>", False))
            close = "</div></div>"
        elif box == "table":
            cell = lambda: f"<td{rng.choice(['', '', ' width=120', ' valign=top'])}>{rng.choice([' '.join(link() for _ in range(rng.randint(2, 6))), '<br>'.join(link() for _ in range(rng.randint(2, 8))), stuff(0), stuff(5)])}</td>"
            top = rng.choice(["", f"<tr>{cell()}{cell()}</tr>"])
            out.append((f"<table>{top}<tr>{cell() if rng.random() < 0.7 else ''}<td>", False))
            close = f"</td>{cell() if rng.random() < 0.3 else ''}</tr></table>"
        else:
            out.append(("<div>" if box == "plain" else "", False))
            close = "</div>" if box == "plain" else ""
        if box == "main" and rng.random() < 0.5:
            out.append((f"<article{tells()}>", False))
            close = "</article>" + close
        head = rng.choice(PARTS_IN)
        title = f"<h1{rng.choice(['', '', f' class={head}-title', ' class=headline'])}>{words(2, 12)}</h1>"
        headed = f"<header{rng.choice(['', f' class={head}-header'])}>{title}</header>" if box in ("article", "main") else f"<div class={head}-header>{title}</div>"
        out.append((rng.choice([title, title, "", headed, headed]), True))
        sections = rng.random() < 0.2
        short = rng.random() < 0.15
        for _ in range(rng.randint(1, 3) if short else rng.randint(2, 12)):
            if rng.random() < 0.17:
                out.append((noise(True), False))
            out.append(((f"<p>{words(1, 9)}</p>" if rng.random() < 0.6 else block() if rng.random() < 0.6 else f"{words(1, 20)} ") if short else f"<section>{block()}{block()}</section>" if sections else inner(block()), True))
        if rng.random() < 0.2:
            out.append((f"<p>{rng.choice(['', f'{words(1, 2)}: ', f'{words(2, 6)} '])}<a href='/x'>{words(2, 9)}</a>{rng.choice(['', '.', f' {words(1, 4)}.'])}</p>", True))
        if box in ("article", "main") and rng.random() < 0.2:
            out.append((rng.choice([f"<footer>{link()} {words(1, 9)}</footer>", noise(True)]), False))
        out.append((close, False))
        out += [(noise(False), False) for _ in range(rng.randint(0, 4))]
        if rng.random() < 0.4:
            tag = rng.choice(["div", "p", "div", "footer"])
            out.append((f"<{tag}>{rng.choice(['&copy; 2020 ', '', 'Copyright '])}{words(2, 12)}{rng.choice(['. All rights reserved.', '.', ''])} {rng.choice(['', link(), link() + ' ' + link()])}</{tag}>", False))
        if rng.random() < 0.1:
            out.append((f"<div hidden>{says()}</div><div style='display:none'>{says()}</div>", False))
        page = [*out, *[(e, False) for e in reversed(ends)]]
        # some pages name nothing that helps
        pages.append([(_NAMES.sub("", p), c) for p, c in page] if rng.random() < 0.25 else page)
    return pages


_NAMES = re.compile(r" (?:class|id)='[^']*'")


def _words(value: str) -> list[str]:
    return [w for w in re.split(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])", value) if w]


def _own(tag: str, attrs: str) -> list[tuple[str, float]]:
    """What is known of an element by itself: its tag and the words of its class, id and role, with their shares.

    In a name put together the first word counts less than by itself, and the others have weights of their own: the last
    one says what it is (sidebar-layout), the first one what for. Words on the page or its article are features of their
    own: there they mostly tell of other parts.
    """
    out = [(tag, 1.0)]
    if attrs and not attrs.isspace():
        kind = "page." if tag in ("html", "body") else "main." if tag in ("article", "main") else "."
        for name, *values in _NAMED.findall(attrs):
            name, value = name.lower(), next((v for v in values if v), "").lower()
            if name in ("class", "id", "role"):
                for one in value.split():
                    words = _words(one)
                    if words and words[0] not in STATES:
                        out.append((kind + words[0], 1.0 if len(words) == 1 else FIRST))
                        out += [(f"{kind}-{w}", 1 / (len(words) - 1)) for w in words[1:]]
            elif tag not in ("html", "body") and (name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value))):
                out.append(("hidden", 1.0))
    return out


def _tokens(page: str) -> Iterator[tuple[str, str, str, int]]:
    """(kind, value, attrs, position): text, start and end tokens in order; what is skipped whole gives its name."""
    last = 0
    for m in _TOKEN.finditer(page):
        if m.start() > last:
            yield "text", page[last : m.start()], "", last
        last = m.end()
        if m["tag"]:
            yield ("end" if m["end"] else "start"), m["tag"].lower(), m["attrs"] or "", m.start()
        else:
            yield "skip", (m["raw"] or "").lower(), "", m.start()
    if last < len(page):
        yield "text", page[last:], "", last


_LEGAL = re.compile("©|&copy;|copyright|all rights reserved", re.I)
#: The first word of a name put together counts this much of what it counts alone.
FIRST = 1.0
#: An element counts this much for the words one level further in.
DECAY = 0.85
#: Words of the main container with log-odds below this are left out; for every LOSS words of their block, by 1 less (2 at most).
AGAINST, LOSS = 0.0, 100
#: Log-odds count this much in the choice of the main container, where many words weigh against a name.
CALM = 0.5
#: Share of a box's words that its parent box counts as its own.
UPWARD = 0.7
#: Most levels a box hands its words up.
LEVELS = 3


class _Page:
    """A page as tokens: texts with their element and block, and the elements' parents.

    ``tokens``: (kind, value, element, block), kind 0 text, 1 start, 2 end, 3 break, 4 skipped element.
    """

    def __init__(self, page: str):
        self.tag, self.parent, self.attrs = ["#"], [0], [""]
        self.link, self.main, self.box, self.list = [False], [False], [0], [0]
        self.tokens: list[tuple[int, str, int, int]] = []
        self.at: list[int] = []
        self.count: list[int] = []
        stack, held, block = [0], {}, 0
        self.block_words, self.block_links = [0], [0]
        for kind, value, attrs, at in _tokens(page):
            if kind == "text":
                n = len(value.split())
                e = stack[-1]
                self.tokens.append((0, value, e, block))
                self.at.append(at)
                self.count.append(n)
                self.block_words[block] += n
                if self.link[e]:
                    self.block_links[block] += n
                continue
            if kind == "skip":
                if value:
                    self.tokens.append((4, value, stack[-1], block))
                    self.at.append(at)
                    self.count.append(0)
                continue
            if kind == "start":
                if value in BLOCKS and self.tag[stack[-1]] == "p":
                    held[self.tag[stack.pop()]] -= 1
                elif value == "li" and self.tag[stack[-1]] == "li":
                    held[self.tag[stack.pop()]] -= 1
                e = up = stack[-1]
                if value not in VOID and not attrs.endswith("/"):
                    e = len(self.tag)
                    self.tag.append(value)
                    self.attrs.append(attrs)
                    self.parent.append(up)
                    self.link.append(self.link[up] or value == "a")
                    self.main.append(self.main[up] or value in ("article", "main"))
                    self.box.append(e if value in BLOCKS and value not in _LINES else self.box[up])
                    self.list.append(e if value in _LISTS else 0 if value in ("td", "th") else self.list[up])
                    stack.append(e)
                    held[value] = held.get(value, 0) + 1
            else:
                e = stack[-1]
                if held.get(value):
                    while self.tag[stack[-1]] != value:
                        held[self.tag[stack.pop()]] -= 1
                    e = stack[-1]
                    held[self.tag[stack.pop()]] -= 1
            if value in BLOCKS:
                block += 1
                self.block_words.append(0)
                self.block_links.append(0)
            self.tokens.append((3 if value == "br" else 1 if kind == "start" else 2, value, e, block))
            self.at.append(at)
            self.count.append(0)
        self.box_words, self.box_links = [0] * len(self.tag), [0] * len(self.tag)
        self.list_words, self.list_links = [0] * len(self.tag), [0] * len(self.tag)
        for (k, _, e, _), n in zip(self.tokens, self.count, strict=True):
            if k == 0:
                for words, links, at in ((self.box_words, self.box_links, self.box[e]), (self.list_words, self.list_links, self.list[e])):
                    words[at] += n
                    links[at] += n if self.link[e] else 0
        self.boxed = any(k == 0 and n and self.main[e] for (k, _, e, _), n in zip(self.tokens, self.count, strict=True))

    def rest(self, i: int, inside: list[bool] | None = None) -> list[float]:
        """Numbers about a text token besides its elements; ``inside`` (the main container), when known, comes last.

        Links in a block count only outside of articles and of the main container; a list or a box that is nothing but
        links counts anywhere.
        """
        _, value, e, block = self.tokens[i]
        n, box, items = self.block_words[block], self.box[e], self.list[e]
        own = self.main[e] or (inside is not None and inside[e])
        share = self.block_links[block] / n if n and not own else 0.0
        listed = self.list_links[items] / self.list_words[items] if items and self.list_words[items] else 0.0
        boxed = self.box_links[box] / self.box_words[box] if self.box_words[box] else 0.0
        legal = 1.0 if n < 40 and _LEGAL.search(value) else 0.0
        out = [1.0, float(self.link[e] and not own), share, min(4.0, math.log1p(n)), float(self.boxed and not self.main[e]), legal, listed, max(0.0, 2 * boxed - 1)]
        return out if inside is None else [*out, float(inside[e])]

    def container(self, odds: list[float]) -> tuple[list[bool], list[bool]]:
        """For every element, whether it stands in the box that holds most content by ``odds`` of the text tokens, and
        whether it is that box or stands around it (then its names tell nothing of one part against another)."""
        held = [0.0] * len(self.tag)
        k = 0
        for i, (kind, _, e, _) in enumerate(self.tokens):
            if kind == 0:
                n = self.count[i]
                if n:
                    b, give = self.box[e], n / (1 + math.exp(-max(-30.0, min(30.0, CALM * odds[k]))))
                    for _ in range(LEVELS):
                        held[b] += give
                        give *= UPWARD
                        if not b:
                            break
                        b = self.box[self.parent[b]]
                k += 1
        top = held.index(max(held))
        inside = [False] * len(self.tag)
        for e in range(len(self.tag)):
            inside[e] = e == top or (e > 0 and inside[self.parent[e]])
        around = [False] * len(self.tag)
        while top:
            around[top], top = True, self.parent[top]
        return inside, around


class Weights:
    """Weights of elements and of the other numbers, and tag costs, fitted on labelled pages."""

    def __init__(self, pages: list[list[tuple[str, bool]]], penalty: float = 1.0):
        parsed, labels, tags = [], [], {}  # labels: of every token of a page
        for pieces in pages:
            page = _Page("".join(p for p, _ in pieces))
            ends = np.cumsum([len(p) for p, _ in pieces])
            content = [c for _, c in pieces]
            own = [content[int(np.searchsorted(ends, at, side="right"))] for at in page.at]
            parsed.append(page)
            labels.append(own)
            for (kind, value, _, _), y in zip(page.tokens, own, strict=True):
                if kind == 1:
                    tags.setdefault(value, [0, 0])[y] += 1
        self.cost = {t: max(0.02, min(2.0, math.log((c[0] + 1) / (c[1] + 1)))) for t, c in tags.items()}
        self.names: dict[str, int] = {}
        for page in parsed:
            for tag, attrs in zip(page.tag, page.attrs, strict=True):
                for f, _ in _own(tag, attrs):
                    self.names.setdefault(f, len(self.names))
        m, k = len(self.names), len(parsed[0].rest(0))
        texts = [[i for i, t in enumerate(page.tokens) if t[0] == 0] for page in parsed]
        target = np.array([float(own[i]) for own, some in zip(labels, texts, strict=True) for i in some])
        weight = np.array([min(12.0, page.count[i]) for page, some in zip(parsed, texts, strict=True) for i in some])
        # one table in single precision serves both fits; the last column is for the second
        x = np.zeros((len(target), m + k + 1), np.float32)

        def fill(at: int, page: _Page, some: list[int], *told: list[bool]) -> None:
            inside, around = told or (None, None)
            path = np.zeros((len(page.tag), m), np.float32)
            for e in range(1, len(page.tag)):
                path[e] = DECAY * path[page.parent[e]]
                for f, share in () if around and around[e] else _own(page.tag[e], page.attrs[e]):
                    path[e, self.names[f]] += share
            for row, i in enumerate(some, at):
                rest = page.rest(i, inside)
                x[row, :m], x[row, m : m + len(rest)] = path[page.tokens[i][2]], rest

        starts = np.cumsum([0, *map(len, texts)]).tolist()
        for at, page, some in zip(starts, parsed, texts, strict=False):
            fill(at, page, some)
        # first without the main container, which needs odds itself
        first = self._fit(x[:, :-1], target, weight, penalty)
        odds = x[:, :-1] @ first
        for at, page, some in zip(starts, parsed, texts, strict=False):
            fill(at, page, some, *page.container(odds[at : at + len(some)].tolist()))
        both = self._fit(x, target, weight, penalty)
        self.first = (dict(zip(self.names, first[:m].tolist(), strict=True)), first[m:].tolist())
        self.both = (dict(zip(self.names, both[:m].tolist(), strict=True)), both[m:].tolist())
        self._cache: dict[tuple[str, str], tuple[float, float]] = {}

    @staticmethod
    def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float) -> np.ndarray:
        """Ridge logistic regression by Newton steps."""
        w = np.zeros(x.shape[1])
        for _ in range(12):
            h, g = penalty * np.eye(len(w)), -penalty * w
            for i in range(0, len(x), 4096):
                part, c = x[i : i + 4096], weight[i : i + 4096]
                p = 1 / (1 + np.exp(-np.clip(part @ w, -30, 30)))
                # single precision bends a step a little, not where the steps end
                h += (part * (c * np.maximum(p * (1 - p), 1e-4)).astype(np.float32)[:, None]).T @ part
                g += (c * (y[i : i + 4096] - p)) @ part
            step = np.linalg.solve(h, g)
            w += step
            if np.abs(step).max() < 1e-3:
                break
        return w

    def element(self, tag: str, attrs: str) -> tuple[float, float]:
        """Weights of an element by itself, in the first and the second fit."""
        key = (tag, attrs)
        if key not in self._cache:
            if len(self._cache) > 20_000:
                self._cache.clear()
            own = _own(tag, attrs)
            self._cache[key] = (sum(share * self.first[0].get(f, 0.0) for f, share in own), sum(share * self.both[0].get(f, 0.0) for f, share in own))
        return self._cache[key]

    def scored(self, source: str) -> tuple[_Page, list[float], list[bool]]:
        """A page, the log-odds of each of its text tokens, and which elements are in the main container."""
        page = _Page(source)
        n = len(page.tag)
        one, two = [0.0] * n, [0.0] * n
        own = [(0.0, 0.0), *[self.element(page.tag[e], page.attrs[e]) for e in range(1, n)]]
        for e in range(1, n):
            one[e] = DECAY * one[page.parent[e]] + own[e][0]
        texts = [(i, t[2]) for i, t in enumerate(page.tokens) if t[0] == 0]
        told = lambda path, w, i, e, *inside: path[e] + sum(map(float.__mul__, w, page.rest(i, *inside)))
        inside, around = page.container([told(one, self.first[1], i, e) for i, e in texts])
        for e in range(1, n):
            two[e] = DECAY * two[page.parent[e]] + (0.0 if around[e] else own[e][1])
        return page, [told(two, self.both[1], i, e, inside) for i, e in texts], inside

    @staticmethod
    def region(gains: list[float]) -> tuple[int, int]:
        """The first shortest run of tokens (end exclusive) with the largest sum: one linear scan."""
        best = now = 0.0
        first = last = start = 0
        for i, g in enumerate(gains):
            if now <= 0:
                start, now = i, 0.0
            now += g
            if now > best + 1e-12:
                best, first, last = now, start, i + 1
        return first, last

    def extract(self, source: str | None) -> str:
        """The main text of a page, blocks apart by an empty line."""
        if not source:
            return ""
        page, odds, inside = self.scored(source)
        # on a page with an article, words that nothing speaks clearly against may be all it says
        level = AGAINST if page.boxed and max(odds, default=0.0) <= 0 else 0.0
        gains, against, k = [], [], 0
        for (kind, value, e, block), n in zip(page.tokens, page.count, strict=True):
            out = False
            if kind == 0:
                o, k = odds[k], k + 1
                out = inside[e] and o < AGAINST - min(2.0, page.block_words[block] / LOSS)
                # what speaks against a text inside the container does not part the content before and after it
                gain = n * math.tanh((o - level) / 2)
                gain *= 0.01 if gain < 0 and inside[e] else 1.0
            elif kind == 4:
                gain, out = 0.0, True
            else:
                gain = -self.cost.get(value, 0.1) * (0.02 if inside[e] else 1.0)
            gains.append(gain)
            against.append(out)
        first, last = self.region(gains)
        blocks: dict[int, list[str]] = {}
        for (kind, value, _, block), out in zip(page.tokens[first:last], against[first:last], strict=True):
            if kind == 0 and not out:
                blocks.setdefault(block, []).append(value)
            elif kind in (3, 4):
                blocks.setdefault(block, []).append(" ")
        done = (" ".join(html.unescape("".join(parts)).split()) for parts in blocks.values())
        return "\n\n".join(x for x in done if x)


def extract(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """Every row of ``pages(page_id, url, html)`` with text and n_chars (its code points)."""
    trained = weights or Weights(labelled_pages())

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = [trained.extract(h) for h in b.column("html").to_pylist()]
        return pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return arrow_map(pages.select("page_id", "url", "html"), run, "page_id long, url string, text string, n_chars long")
