"""Main text of web pages: a linear-chain conditional random field over leaf blocks of the DOM."""

from __future__ import annotations

import html as entities
import json
import random
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import takewhile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillmark.llm.words import by_steps

#: Fixed lists of tags: whose content isn't text, and of these the ones that can end with their parent; of formulas; that have no content; that don't end a block of text; that end an open paragraph.
HIDDEN = ("script", "style", "textarea", "iframe", "title", "head")
HIDDEN_PARTS = frozenset("template select svg object annotation annotation-xml".split())
MATH = frozenset("math annotation annotation-xml maction menclose merror mfenced mfrac mi mlongdiv mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()) | MATH
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: Words in class, id and role that tell what a part of a page is for.
OF_KIND = {
    "advert": "ad ads advert adverts advertisement advertising adsense banner promo promotion promoted sponsor sponsored sponsors dfp outbrain taboola",
    "notice": "alert consent cookie cookies disclaimer gdpr modal notice notification overlay paywall popup privacy toast warning",
    "menu": "breadcrumb breadcrumbs crumbs dropdown links menu nav navbar navigation pager pagination tabs toc toolbar topbar",
    "head": "header heading-bar logo masthead site-header topnav",
    "foot": "bottom copyright footer footnav imprint legal",
    "side": "aside more popular recommended recommendations related rail sidebar teaser trending widget widgets",
    "comment": "comment comments commentlist discussion disqus feedback replies reply respond responses",
    "form": "form login newsletter search searchbox share sharing signin signup social subscribe subscription",
    "content": "article articlebody body content entry main post postbody prose story storybody text",
}
KIND_OF = {w: k for k, words in OF_KIND.items() for w in words.split()}
KIND_ONLY = frozenset("main content body text".split())  # too common a part of longer names to tell anything there
#: Parts of names that say that something is or isn't beside an element, not what it is.
LAYOUT_PARTS = frozenset("has have no not non with without free less hide hidden off layout wrap wrapper page".split())
RIGHTS = re.compile(r"©|\(c\)|\bcopyright\b|\ball rights reserved\b", re.I)
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + "|".join(t for t in HIDDEN if t != "head") + r")\b[^>]*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-z][a-z0-9:-]*+)([^>]*+)>|<[!?/][^>]*+>",
    re.I | re.S,
)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PARTS = re.compile(r"[a-z]+")
VALUE_END = re.compile(r"=\s*[^\s\"'=]+$")  # a slash behind it belongs to the value


STYLE = re.compile(r"\bstyle\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
HIDDEN_ATTRIBUTE = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)", re.I)


@dataclass(slots=True)
class Element:
    """An element of a page: the one it is in, its number in page order, its tag, what its names tell, whether it isn't shown, the tags it is in and its own;
    whether it holds a main heading or an article, a main heading, and its characters of text."""

    parent: Element | None
    number: int
    tag: str
    kinds: frozenset[str]
    unseen: bool
    inside: frozenset[str]
    holds: bool = False
    headed: bool = False
    size: int = 0


@dataclass
class Block:
    text: str
    element: Element
    linked: int


def _names(tag: str, attributes: str) -> frozenset[str]:
    """What the class, id and role of a tag tell; of articles, whole names alone, as parts of them tell of topics."""
    found = set()
    for values in NAMES.findall(attributes):
        for name in "".join(values).lower().split():
            if name in KIND_OF:
                found.add(KIND_OF[name])
            elif tag not in ("article", "main"):
                parts = PARTS.findall(name)
                if not LAYOUT_PARTS.intersection(parts):
                    found.update(KIND_OF[p] for p in parts if p in KIND_OF and (p not in KIND_ONLY or len(parts) == 1 or parts[-1] == p and KIND_OF.get(parts[0]) in (None, "content")))
    return frozenset(found)


def _unseen(tag: str, attributes: str) -> bool:
    """Whether an element says that it isn't shown; pages as a whole and their articles may say so until a script shows them."""
    if tag in ("html", "body", "main", "article"):
        return False
    return any(UNSEEN.search("".join(v)) for v in STYLE.findall(attributes)) or bool(HIDDEN_ATTRIBUTE.search(QUOTED.sub("", attributes)))


def blocks(html: str) -> list[Block]:
    """Leaf blocks in page order: text that is shown, between tags that aren't inline, with character references decoded and white space made single.

    The places of open elements are kept by tag, so that a tag costs no more in a deep page than in a flat one.
    """
    out: list[Block] = []
    root = Element(None, 0, "", frozenset(), False, frozenset())
    stack: list[Element] = []
    where: defaultdict[str, list[int]] = defaultdict(list)  # places in stack by tag
    solid: list[int] = []  # of elements that aren't inline
    pieces: list[str] = []
    linked, at, links, unseen, drawn, number = 0, 0, 0, 0, 0, 0
    known: dict[tuple[str, str], tuple[frozenset[str], bool]] = {}

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append(Block(text, stack[solid[-1]] if solid else stack[-1] if stack else root, min(linked, len(text))))
            pieces.clear()
        linked = 0

    def text(piece: str) -> None:
        nonlocal linked
        if piece and not unseen:
            piece = entities.unescape(piece)
            pieces.append(piece)
            if links:
                linked += len(piece.strip())

    def close(i: int) -> None:
        """Ends the elements from the i-th open one on."""
        nonlocal links, unseen, drawn
        while len(stack) > i:
            e = stack.pop()
            where[e.tag].pop()
            if solid and solid[-1] == len(stack):
                solid.pop()
            links -= e.tag == "a"
            unseen -= e.unseen
            drawn -= e.tag in ("svg", "math")

    def held(i: int) -> bool:
        """Whether an element that isn't inline is open within the i-th, outside hidden parts."""
        k = bisect_right(solid, i)
        return k < len(solid) and not any(e.tag in HIDDEN_PARTS for e in stack[i + 1 : solid[k] + 1])

    def barred(i: int, cell: bool) -> bool:
        """Whether an element is open within the i-th that keeps the next tag from ending that."""
        above = takewhile(lambda k: k > i, reversed(solid))
        return any(stack[k].tag != "svg" and not (cell and stack[k].tag == "p") for k in above)

    for m in TAG.finditer(html):
        text(html[at : m.start()])
        at = m.end()
        name = m[3] or m[6]
        if name is None:
            if m[1]:
                flush()
            continue
        closing, name, attributes = m[2] or m[5], name.lower(), m[4] or m[7] or ""
        if name not in INLINE:
            flush()
        elif name in ("br", "wbr", "img"):
            pieces.append(" " if name == "br" else "")
            continue
        if closing:
            if where[name] and not (name in INLINE and held(where[name][-1])):
                close(where[name][-1])
            continue
        if name in VOID or attributes.endswith("/") and (name == "svg" or name in MATH or drawn) and not VALUE_END.search(attributes):
            continue
        ends = "p" if name in ENDS_P else name if name in ("li", "td", "th", "tr", "option", "dt", "dd") else ""
        if ends and where[ends] and not barred(where[ends][-1], ends in ("td", "th", "li", "dt", "dd")):
            close(where[ends][-1])
        if (name, attributes) not in known:
            known[name, attributes] = _names(name, attributes) if name not in ("html", "body") else frozenset(), name in HIDDEN_PARTS or _unseen(name, attributes)
        kinds, gone = known[name, attributes]
        parent, number = stack[-1] if stack else root, number + 1
        links += name == "a"
        unseen += gone
        drawn += name in ("svg", "math")
        where[name].append(len(stack))
        if name not in INLINE:
            solid.append(len(stack))
        stack.append(Element(parent, number, name, kinds, gone, parent.inside if name in parent.inside else parent.inside | {name}))
    text(html[at:])
    flush()
    return [b for b in out if "head" not in b.element.inside or "body" in b.element.inside]


def _above(element: Element) -> Iterator[Element]:
    """An element and those it is in, outwards."""
    while element is not None:
        yield element
        element = element.parent


#: Ancestor tags that set a block apart from the article it stands in.
SETS_APART = frozenset(("aside", "nav", "footer", "header", "form", "button", "noscript", "dialog"))
APART = frozenset(f"in:{t}" for t in SETS_APART)
SENTENCE = re.compile(r"[.!?。！？…][\"'”’)\]]*$")


def _sized(found: list[Block]) -> int:
    """Sums up the text of each element, and whether it holds a main heading or an article, from the inside outwards, once for each element; returns all text's characters."""
    elements: dict[int, Element] = {}
    for b in found:
        for e in takewhile(lambda e: e.number not in elements, _above(b.element)):
            elements[e.number] = e
            e.size, e.holds, e.headed = 0, e.tag in ("h1", "article", "main"), e.tag == "h1"
    for b in found:
        b.element.size += len(b.text)
    for n in sorted(elements, reverse=True):
        e = elements[n]
        if e.parent is not None:
            e.parent.size += e.size
            e.parent.holds, e.parent.headed = e.parent.holds or e.holds, e.parent.headed or e.headed
    return sum(len(b.text) for b in found)


def block_features(found: list[Block]) -> list[list[str]]:
    """Names of the features of each block: ancestor tags, what names of ancestors tell, its place, and its text.

    What the names and the tag of a wrapper tell, of an element that has half of a page's text or more and a main heading in it, or an article in pages without (or of an article with a main heading, or a form with three quarters of the text), counts for
    nothing: they tell of the layout. Of the others, the nearest that tells anything counts on its own besides.
    """
    whole = _sized(found)
    headed = next((i for i, b in enumerate(found) if "h1" in b.element.inside), None)
    tags = {t for t in ("article", "main") if any(t in b.element.inside for b in found)}
    known: dict[int, tuple[frozenset[str], str]] = {}

    def told(element: Element) -> tuple[frozenset[str], str]:
        """Features of the blocks in an element; what the nearest names tell."""
        todo = [e for e in takewhile(lambda e: e.number not in known, _above(element))]
        for e in reversed(todo):
            above, near = known[e.parent.number] if e.parent is not None else (frozenset(), "")
            main = e.holds if headed is None else e.headed
            wraps = e.tag != "h1" and (main and 2 * e.size >= whole or e.headed and e.tag in ("article", "main") or e.tag == "form" and 4 * e.size >= 3 * whole)
            kinds = frozenset() if wraps else e.kinds
            own = {f"kind:{k}" for k in kinds}
            if e.tag not in ("", "html", "body") and not (wraps and e.tag in SETS_APART):
                own.add(f"in:{e.tag}")
            known[e.number] = above if own <= above else above | own, "+".join(sorted(kinds)) or near
        return known[element.number]

    out = []
    for i, b in enumerate(found):
        inside, near = told(b.element)
        words = b.text.count(" ") + 1
        own = [*inside, "bias", f"words:{min(6, words.bit_length())}", f"links:{min(4, 5 * b.linked // max(1, len(b.text)))}", f"leaf:{b.element.tag}", f"near:{near}"]
        own += [said := "sentence" if SENTENCE.search(b.text) else "no sentence"]
        own += [f"{said} words:{min(4, words.bit_length())} links:{min(4, 5 * b.linked // max(1, len(b.text)))}"]
        own += ["sign"] if any(c in b.text for c in "©®»›") else []
        own += ["only block"] if len(found) == 1 else []
        own += [f"leaf:{b.element.tag} before"] if headed is not None and i < headed else []
        own += [f"out of {t}" for t in tags if f"in:{t}" not in inside]
        own += ["before heading"] if headed is not None and i < headed else ["after heading"] if headed is not None else []
        apart = inside & APART or near not in ("", "content")
        own += [("apart" if apart else "clear") + (where := " in article" if inside & {"in:article", "in:main"} else " in content" if near == "content" else "")]
        own += ["rights" + where] if RIGHTS.search(b.text) else []
        out.append(own)
    return out


@dataclass(frozen=True)
class PageModel:
    """What each feature adds to a block's being main text; what a step from a label to the next adds; what the first label adds."""

    weights: dict[str, float]
    steps: tuple[tuple[float, float], tuple[float, float]]
    first: tuple[float, float]

    def decode(self, found: list[list[str]]) -> list[bool]:
        """The best labels by Viterbi."""
        if not found:
            return []
        score = [sum(self.weights.get(f, 0.0) for f in fs) for fs in found]
        (s00, s01), (s10, s11) = self.steps
        a, b = self.first[0], self.first[1] + score[0]
        back = []
        for x in score[1:]:
            back.append((b + s10 > a + s00, b + s11 > a + s01))
            a, b = max(a + s00, b + s10), max(a + s01, b + s11) + x
        label = b > a
        out = [label]
        for to in reversed(back):
            label = to[label]
            out.append(label)
        return out[::-1]


def train_crf(pages: list[tuple[list[list[str]], list[bool]]], epochs: int = 250, rate: float = 0.1, decay: float = 2e-4) -> PageModel:
    """Maximum likelihood of labelled pages, with forward and backward sums over all pages at once; Adam, and a little decay."""
    names = sorted({f for fs, _ in pages for own in fs for f in own})
    number = {f: i for i, f in enumerate(names)}
    n, longest = len(pages), max(len(y) for _, y in pages)
    on, label = np.zeros((n, longest), bool), np.zeros((n, longest), int)
    where, feature = [], []
    for i, (fs, y) in enumerate(pages):
        on[i, : len(y)], label[i, : len(y)] = True, y
        for t, own in enumerate(fs):
            where += [i * longest + t] * len(own)
            feature += [number[f] for f in own]
    where, feature = np.array(where), np.array(feature)
    p = np.zeros(len(names) + 6)
    m, v = np.zeros_like(p), np.zeros_like(p)
    last = on.sum(axis=1) - 1
    both = on[:, 1:] & on[:, :-1]
    gold = np.bincount(feature, label.ravel()[where], len(names))
    gold_steps = np.array([[(both & (label[:, :-1] == a) & (label[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)], float)
    gold_first = np.bincount(label[:, 0], minlength=2).astype(float)
    add = lambda x: np.logaddexp(x[..., 0], x[..., 1])
    for epoch in range(1, epochs + 1):
        w, steps, first = p[:-6], p[-6:-2].reshape(2, 2), p[-2:]
        emit = np.zeros((n, longest, 2))
        emit[..., 1] = np.bincount(where, w[feature], n * longest).reshape(n, longest)
        forward, backward = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        forward[:, 0] = first + emit[:, 0]
        for t in range(1, longest):
            forward[:, t] = np.stack([add(forward[:, t - 1] + steps[:, b]) for b in (0, 1)], axis=1) + emit[:, t]
        for t in range(longest - 2, -1, -1):
            follow = np.stack([add(backward[:, t + 1] + emit[:, t + 1] + steps[a]) for a in (0, 1)], axis=1)
            backward[:, t] = np.where((t < last)[:, None], follow, 0)
        total = add(forward[np.arange(n), last])[:, None]
        one = np.exp(forward[..., 1] + backward[..., 1] - total) * on
        pair = np.exp(forward[:, :-1, :, None] + steps + (emit + backward)[:, 1:, None, :] - total[..., None, None]) * both[..., None, None]
        start = np.exp(forward[:, 0] + backward[:, 0] - total).sum(axis=0)
        g = np.concatenate([np.bincount(feature, one.ravel()[where], len(names)) - gold, (pair.sum(axis=(0, 1)) - gold_steps).ravel(), start - gold_first]) / n + decay * p
        m, v = m + 0.1 * (g - m), v + 0.01 * (g**2 - v)
        p -= rate * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-9)
    steps = p[-6:-2].tolist()
    return PageModel(dict(zip(names, p[:-6].tolist(), strict=True)), ((steps[0], steps[1]), (steps[2], steps[3])), tuple(p[-2:].tolist()))


def labelled_page(rng: random.Random) -> tuple[str, list[bool]]:
    """A made-up page and, for each of its blocks, whether it is main text: layouts, tags and names as pages commonly have them.

    Names of furniture also stand on bodies, wrappers, articles and paragraphs, where they tell of the layout or the topic; some pages have no names and
    few tags that tell anything; articles may be a sentence long and may have headers, footers and by-lines of their own.
    """
    word = lambda: "".join(rng.choice(("ka", "lo", "mi", "ren", "tu", "sa", "el", "or", "vin", "pe")) for _ in range(rng.randint(1, 4)))
    phrase = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    sentence = lambda: phrase(2, 18).capitalize() + rng.choice("...?!")
    prose = lambda a, b: " ".join(sentence() for _ in range(rng.randint(a, b)))
    chance = lambda p: rng.random() < p
    furniture = lambda: rng.choice(OF_KIND[rng.choice([k for k in OF_KIND if k != "content"])].split())
    label: list[bool] = []
    plain, alone = chance(0.15), chance(0.08)  # no names, no tags of sections; nothing beside the article

    def leaf(tag: str, inner: str, main: bool, attributes: str = "") -> str:
        label.append(main)
        if chance(0.2):
            inner = f"<{(t := rng.choice(('b', 'em', 'span', 'strong')))}>{inner}</{t}>"
        if not plain and not attributes and chance(0.04):
            attributes = f' class="{rng.choice((f"{furniture()}-free", f"no-{furniture()}", f"{word()}-{word()}"))}"'
        return f"<{tag}{attributes}>{inner}" + ("" if tag in ("p", "li") and chance(0.15) else f"</{tag}>")

    def named(kind: str, sure: bool = False) -> str:
        if plain:
            return ""
        if not sure and chance(0.2):
            return f' class="{word()}-{word()}"' if chance(0.5) else ""  # names that tell nothing
        name = rng.choice(OF_KIND[kind].split())
        name = rng.choice((name, name, f"{name}-{word()}", f"{word()}_{name}", f"site-{name}"))
        return f' {rng.choice(("class", "id"))}="{name}"'

    def layout() -> str:
        """Names on an element that holds the article and more."""
        name = rng.choice((f"has-{furniture()}", f"no-{furniture()}", f"{rng.choice(('left', 'right', word()))}-{furniture()}", f"{furniture()}-{word()}", f"page-with-{furniture()}", furniture(), word()))
        return f' {rng.choice(("class", "class", "id"))}="{name}"' if not plain and chance(0.5) else ""

    def wrap(kind: str, tag: str, inner: str, sure: bool = False) -> str:
        if plain:
            return f"<{(t := rng.choice(('div', 'div', 'section')))}>{inner}</{t}>"
        if tag and chance(0.5):
            return f"<{tag}{named(kind) if chance(0.4) else ''}>{inner}</{tag}>"
        tag = rng.choice(("div", "section"))
        return f"<{tag}{named(kind, sure)}>{inner}</{tag}>"

    def items(a: int, b: int) -> str:
        links = [f'<a href="/{word()}">{phrase(1, 6)}</a>' for _ in range(rng.randint(a, b))]
        kind = rng.random()
        if kind < 0.7:
            return "<ul>" + "".join(leaf("li", x, False) for x in links) + "</ul>"
        return "".join(leaf(rng.choice(("p", "div")), x, False) for x in links) if kind < 0.85 else f"<div>{bare(rng.choice((' ', ' | ', ' &middot; ')).join(links))}</div>"

    def odd() -> str:
        kind = rng.choice(("advert", "notice", "side", "side", "form", "menu", "noscript", "dialog", "unseen"))
        if kind == "dialog":
            return f"<dialog{rng.choice((' open', ''))}{named('notice') if chance(0.4) else ''}>{leaf('p', prose(1, 2), False) if chance(0.7) else bare(prose(1, 2))}</dialog>"
        if kind == "unseen":
            return f'<div style="display{rng.choice((":", ": "))}none">{prose(1, 2)}</div>'
        if kind == "noscript":
            return f"<noscript>{leaf('p', prose(1, 1), False) if chance(0.5) else bare(prose(1, 1))}</noscript>"
        if plain:
            kind = rng.choice(("form", "menu"))
        if kind == "advert":
            return wrap(kind, "", leaf("p", prose(1, 2), False) if chance(0.6) else bare(prose(1, 3)), sure=True)
        if kind == "notice":
            return wrap(kind, "", leaf("p", prose(1, 2), False) + leaf("button", phrase(1, 2), False), sure=True)
        if kind == "form":
            return f"<form{named(kind)}>" + leaf("label", prose(1, 1), False) + "<input><br>" + leaf("button", phrase(1, 2), False) + "</form>"
        return wrap(kind, {"side": "aside", "menu": "nav"}[kind], (leaf("h3", phrase(1, 3), False) if chance(0.5) and not plain else "") + (items(2, 6) if chance(0.5) or plain else leaf("p", prose(1, 2), False)), sure=True)

    def bare(inner: str) -> str:
        label.append(False)
        return inner

    def comments() -> str:
        one = lambda: leaf("p", phrase(1, 3), False) + leaf("p", prose(1, 4), False)
        tag = rng.choice(("div", "div", "article"))
        return wrap("comment", "", sure=True, inner=leaf("h3", phrase(1, 2), False) + "".join(f"<{tag}{named('comment') if chance(0.5) else ''}>{one()}</{tag}>" for _ in range(rng.randint(1, 6))))

    def by_line(tag: str) -> str:
        return f"<{tag}>" + (leaf("p", rng.choice((f"By {phrase(1, 3).title()}", phrase(1, 6), prose(1, 1), f"{phrase(1, 2).title()}, 3 {word()} 2021")), False)) + (items(1, 3) if chance(0.3) else "") + f"</{tag}>"

    def rights() -> str:
        mark = rng.choice(("&copy;", "&copy;", "Copyright", "Copyright &copy;", "(c)"))
        return f"{mark} {rng.choice(('', '2019 ', '2024 '))}{phrase(1, 4).title()}{rng.choice(('', '.', ' Ltd', '. All rights reserved.'))}" + (f" {prose(1, 2)}" if chance(0.4) else "")

    def content() -> str:
        if chance(0.3 if alone else 0.08):
            return leaf("p", sentence(), True)
        heading = [leaf("h1", phrase(2, 10), True)] if plain or chance(0.85) else []
        if heading and not plain and chance(0.12):
            heading = ["<header>", *heading, leaf("p", f"By {phrase(1, 3).title()}", False) if chance(0.6) else "", "</header>"]
        parts = heading
        for _ in range(rng.randint(1, 9)):
            kind = rng.random()
            if kind < 0.60:
                parts.append(leaf("p", prose(1, 6) if chance(0.85) else phrase(1, 9), True))
            elif kind < 0.68:
                parts.append(leaf(rng.choice(("h2", "h3")), phrase(1, 8), True))
            elif kind < 0.74:
                parts.append("<ul>" + "".join(leaf("li", phrase(1, 12), True) for _ in range(rng.randint(2, 4))) + "</ul>")
            elif kind < 0.78:
                parts.append("<blockquote>" + leaf("p", prose(1, 2), True) + "</blockquote>")
            elif kind < 0.81:
                parts.append("<table><tr>" + "".join(leaf("td", phrase(1, 4), True) for _ in range(rng.randint(2, 4))) + "</tr></table>")
            elif kind < 0.835:
                parts.append(leaf("p", f'{prose(1, 2)} <a href="/x">{phrase(1, 5)}</a>', True))
            elif kind < 0.845:
                parts.append(leaf("p", rights() if chance(0.5) else "All rights reserved.", True))
            elif kind < 0.855:
                parts.append(f"<noscript>{leaf('p', prose(3, 6), True)}</noscript>")
            else:
                parts.append(odd())
        if chance(0.35):
            tag, cut = rng.choice(("div", "section")), rng.randint(0, len(parts))
            if "<header>" not in parts[cut:] or parts.index("<header>") >= cut:
                parts[cut:] = [f"<{tag}>{''.join(parts[cut:])}</{tag}>"] if "</header>" not in parts[cut:] or "<header>" in parts[cut:] else parts[cut:]
        if not plain and chance(0.2):
            parts.append(comments())
        if not plain and chance(0.15):
            parts.append(by_line("footer"))
        return "".join(parts)

    out = []
    if chance(0.3):
        out.append(odd())
    if chance(0.5) and not plain:
        out.append(wrap("head", "header", leaf(rng.choice(("p", "div", "h2")), phrase(1, 5), False) + (items(2, 5) if chance(0.4) else "")))
    cells = not alone and chance(0.1)  # a table that lays out the page
    if cells:
        out.append("<table><tr><td>" + (items(2, 8) if chance(0.6) else bare(phrase(1, 6))) + "</td><td>")
    elif chance(0.8):
        menu = wrap("menu", "nav", items(2, 8))
        out.append(menu[: -len("</nav>")] if menu.endswith("</nav>") and chance(0.08) else menu)  # some never end
    if chance(0.5):
        out.append(odd())
    before = len(label)
    tag = "div" if plain else rng.choice(("article", "article", "article", "main", "div"))
    names = layout() if tag in ("article", "main") and chance(0.3) else named("content") if tag == "div" or chance(0.3) else ""
    article = f"<{tag}{names}>{content()}</{tag}>"
    if chance(0.3):
        inner = article + (odd() if chance(0.4) and not alone else "")
        article = f"<div{layout()}>{inner}</div>"
    if alone:
        return article, label[before:]
    out.append(article)
    if cells:
        out.append("</td><td>" + (items(1, 5) if chance(0.6) else leaf("p", prose(1, 2), False)) + "</td></tr></table>" if chance(0.6) else "</td></tr></table>")
    if chance(0.4) and not plain:
        out.append(comments())
    if chance(0.5):
        out.append(odd())
    if chance(0.85):
        out.append(wrap("foot", "footer", (leaf("p", rights(), False) if chance(0.5) else bare(rights())) + (items(1, 4) if chance(0.3) else "")))
    inner = "".join(out)
    if chance(0.3):
        inner = f"<div{layout()}>{inner}</div>"
    if chance(0.07):
        inner = f"<form{rng.choice((f' id={chr(34)}{word()}Form{chr(34)}', ' method=post', ''))}>{inner}</form>"
    return f"<html{layout() if chance(0.1) else ''}><head><title>{phrase(2, 6)}</title></head><body{layout()}>{inner}</body></html>", label


def fitted(pages: int = 4000, seed: int = 11) -> PageModel:
    """The field, trained on labelled pages of labelled_page."""
    rng = random.Random(seed)
    made = []
    for _ in range(pages):
        page, label = labelled_page(rng)
        found = blocks(page)
        if len(found) == len(label):
            made.append((block_features(found), label))
    return train_crf(made)


#: Weights as fitted() gives them; written by `python -m quillmark.llm.pages`.
WEIGHTS = Path(__file__).with_name("page_model.json")


@lru_cache(maxsize=1)
def trained() -> PageModel:
    """The field with the weights that were kept, so that no session trains it anew."""
    kept = json.loads(WEIGHTS.read_text(encoding="utf-8"))
    return PageModel(kept["weights"], tuple(map(tuple, kept["steps"])), tuple(kept["first"]))


def keep(model: PageModel) -> None:
    rounded = {f: round(w, 5) for f, w in model.weights.items()}
    WEIGHTS.write_text(json.dumps({"weights": rounded, "steps": model.steps, "first": model.first}, indent=0, ensure_ascii=False) + "\n", encoding="utf-8")


def main_text(html: str | None, model: PageModel) -> str:
    """The blocks of main text, joined by a space; empty if there are none."""
    found = blocks(html) if html else []
    return " ".join(b.text for b, main in zip(found, model.decode(block_features(found)), strict=True) if main)


def extract_pages(pages: DataFrame, html: str = "html", model: PageModel | None = None) -> DataFrame:
    """All rows of pages, and its columns but html, with text (the main text; string) and n_chars (its code points; long).

    Null and empty pages, and those without main text, have an empty text. Columns text and n_chars of pages are replaced. Repeated rows are extracted alike; an empty table gives no rows. A page is one task's
    work, in time linear in its length, however deep it is.
    """
    model = model or trained()
    kept = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    own = pages.select(*kept, html)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_steps(batches):
            texts = [main_text(x.as_py(), model) for x in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[*kept, "text", "n_chars"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[: len(kept)])
    return own.mapInArrow(scan, (schema + ", " if schema else "") + "text string, n_chars long")


if __name__ == "__main__":
    keep(fitted())
