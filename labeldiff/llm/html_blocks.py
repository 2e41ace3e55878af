"""Leaf blocks of HTML pages: runs of text between block-level tags, with what their ancestors and text say about them.

A small tolerant tokenizer: it never fails, unclosed and stray tags included. A start tag of a block closes an open
paragraph, list items and table cells close their siblings, an end tag closes everything up to its start tag. Text of
scripts, styles, comments and of the page's head is markup, not text; the head ends at its end tag or at the first tag or
text that cannot stand in it. A line break is white space.
"""

from __future__ import annotations

import html
import re
from collections.abc import Mapping
from typing import NamedTuple

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|iframe|svg|title|textarea|select)\b(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/][^>]*>"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([a-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b", re.I)
PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

#: Elements that don't break a line of text; all others do.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr input button".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Start tags that close an open element of the same group first.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Where a search for an element to close ends.
BOUNDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words that notices, adverts, forms and footers use; a feature each, the weights are learnt.
CUES = frozenset("© copyright cookie cookies subscribe newsletter sign login log register advertisement sponsored share tweet follow reply comment comments posted related privacy rights reserved search menu home contact menü suche datenschutz impressum anzeige kommentar kommentare publicité commentaire commentaires accueil buscar inicio publicidad comentario comentarios".split())
STOPS = str.maketrans(".,:;!?()|\"'", " " * 11)


#: What may stand in a page's head; anything else ends it, as the end tag would.
HEAD = frozenset("base basefont bgsound link meta noframes object param command head".split())


class Block(NamedTuple):
    """A run of text with its own features and those of its ancestors; where weights are given, ancestors only count as the sum of theirs."""

    text: str
    features: tuple[str, ...]
    gain: int


class Element:
    """A start tag: its name and the features it gives to all text within (a dict for its order)."""

    __slots__ = ("tag", "marks")
    known: dict[tuple[str, str], Element] = {}

    def __init__(self, tag: str, attrs: str):
        self.tag, self.marks = tag, {} if tag in ("html", "body") else {f"t={tag}": None}
        if "=" in attrs or "hidden" in attrs.lower():
            for name, a, b, c, hidden in ATTRIBUTE.findall(attrs):
                name, value = name.lower(), a or b or c
                if name in ("class", "id", "role", "itemprop", "aria-label"):
                    self.marks.update((f"c={w.lower()}", None) for w in PIECE.findall(value))
                elif hidden or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                    self.marks["hidden"] = None

    @classmethod
    def of(cls, tag: str, attrs: str) -> Element:
        got = cls.known.get((tag, attrs))
        if got is None:
            got = cls(tag, attrs)
            if len(cls.known) < 10_000 and len(attrs) < 200:
                cls.known[tag, attrs] = got
        return got


class Stack:
    """Open elements. Every question is answered from counts and places that are kept as elements come and go, so a page costs time in proportion to its length however deep it is nested."""

    def __init__(self, weights: Mapping[str, int] | None):
        self.items: list[Element] = []
        self.places: dict[str, list[int]] = {}  # tag -> where it is open
        self.breaking: list[int] = []  # where elements that break a line are open
        self.marks: dict[str, int] = {}  # features of open elements, how often each
        self.weights, self.gain = weights, 0

    def push(self, e: Element) -> None:
        self.places.setdefault(e.tag, []).append(len(self.items))
        if e.tag not in INLINE:
            self.breaking.append(len(self.items))
        self.items.append(e)
        for m in e.marks:
            n = self.marks.get(m, 0)
            self.marks[m] = n + 1
            if not n and self.weights is not None:
                self.gain += self.weights.get(m, 0)

    def pop_to(self, at: int) -> None:
        while len(self.items) > at:
            e = self.items.pop()
            self.places[e.tag].pop()
            if e.tag not in INLINE:
                self.breaking.pop()
            for m in e.marks:
                n = self.marks[m] - 1
                if n:
                    self.marks[m] = n
                else:
                    del self.marks[m]
                    if self.weights is not None:
                        self.gain -= self.weights.get(m, 0)

    def last(self, tags) -> int:
        """Where the innermost open element of these tags is; -1 if none is."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def block(self) -> str:
        return self.items[self.breaking[-1]].tag if self.breaking else "body"


def blocks(page: str, weights: Mapping[str, int] | None = None) -> list[Block]:
    """The page's leaf blocks in page order. weights: whole-number weights of features, for ``Block.gain``."""
    stack = Stack(weights)
    run: list[str] = []
    linked, found = 0, []  # characters of the open run within links; (text, marks, gain, own block, link share)

    def flush():
        nonlocal linked
        if run:
            text = " ".join("".join(run).split())
            if text and not stack.places.get("head"):
                found.append((text, tuple(stack.marks) if weights is None else (), stack.gain, stack.block(), linked / max(1, sum(map(len, run)))))
            run.clear()
            linked = 0

    for m in TOKEN.finditer(page):
        text = m["text"]
        if text is not None:
            text = html.unescape(text) if "&" in text else text
            if stack.places.get("head") and stack.items[-1].tag == "head" and text.strip():
                stack.pop_to(stack.places["head"][-1])
            run.append(text)
            if stack.places.get("a"):
                linked += len(text)
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["close"]:
            at = stack.last((tag,))
            if tag not in INLINE or at >= 0 and stack.breaking and stack.breaking[-1] >= at:
                flush()
            if at >= 0:
                stack.pop_to(at)
            continue
        if stack.places.get("head") and tag not in HEAD:
            run.clear()
            stack.pop_to(stack.places["head"][-1])
        if tag == "br":
            run.append(" ")
            continue
        if tag not in INLINE:
            flush()
            own = SIBLINGS.get(tag)
            if own:
                at = stack.last(own)
                if at > stack.last(BOUNDS.get(tag, ())):
                    stack.pop_to(at)
            elif stack.breaking and stack.items[stack.breaking[-1]].tag == "p":
                stack.pop_to(stack.breaking[-1])
        if tag not in VOID and not m["attrs"].endswith("/"):
            stack.push(Element.of(tag, m["attrs"] if tag != "a" else ""))
    flush()
    n = len(found)
    return [Block(text, features(text, marks, block, share, k, n), gain) for k, (text, marks, gain, block, share) in enumerate(found)]


def features(text: str, marks: tuple[str, ...], block: str, link_share: float, k: int, n: int) -> tuple[str, ...]:
    out: dict[str, None] = dict.fromkeys(marks)
    words = text.count(" ") + 1
    out[f"own={block}"] = None
    out["n=" + ("1" if words < 2 else "2" if words < 4 else "4" if words < 9 else "9" if words < 20 else "20" if words < 60 else "60")] = None
    out["link=" + ("0" if link_share == 0 else "1" if link_share < 0.35 else "2" if link_share < 0.8 else "3")] = None
    if text[-1] in ".!?…:;\"”»":
        out["stop"] = None
    if block in HEADINGS:
        out["heading"] = None
    if block == "body":
        out["bare"] = None
    if words < 60:
        said = set(text.lower().translate(STOPS).split())
        if not CUES.isdisjoint(said):
            out.update((f"cue={c}", None) for c in sorted(CUES & said))
    out["at=" + ("first" if k == 0 else "last" if k == n - 1 else "early" if 10 * k < n else "late" if 10 * k >= 9 * n else "mid")] = None
    return tuple(out)
