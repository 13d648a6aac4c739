"""Main text of web pages by minimum-cut labelling.

A page is cut into text blocks with their chain of open elements. A linear
classifier (fixed weights over tag, class, link and wording cues) gives each block a
score: above zero it prefers "content", below zero "boilerplate". Class, id and role count by whole
names, or a name's first or last word; a word that themes also use on articles (``SOFT``) costs so little
that long unlinked paragraphs outweigh it, and a name on an element that holds nearly all of
the page's long unlinked text is no cue at all. The scores become
the capacities to the two terminals. Neighbours in page order, and each element
with its parent element, are tied by smoothness capacities, so that a short
paragraph between long ones goes with them. The minimum cut is the labelling with
the least total cost; blocks on the source side are the main text.

Before the max-flow, nodes whose terminal outweighs all their ties take their side
(their ties then count for the neighbours); this never changes the minimum and leaves
a small rest to the flow.

Character references are decoded, white space inside a block becomes one space, and
blocks are joined by one space in page order. Scripts, styles, comments in the
markup and hidden elements are no text.

Defined results: a null, empty or textless page gives the empty text; cut-off markup
is read as far as it goes; every input row gives one row. Pages are independent, so
there is no shuffle and a hot group of equal pages needs no care.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfguard.llm.common import in_small_batches

_ATTRS = r"""[^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*"""
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)({_ATTRS})(?:>|\Z)|</?[a-zA-Z][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_TOKENS = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
RAW = frozenset("script style noscript template textarea title svg iframe object canvas audio video select datalist head".split())
#: Elements that leave the line of text they stand in unbroken.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark math mfenced mfrac mi mn mo mover mroot mrow ms mspace msqrt mstyle msub "
    "msubsup msup mtext munder munderover q s samp semantics small span strike strong sub sup time tt u var wbr".split()
)
#: What an opening tag closes, as browsers do.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: An end tag or an implied one does not reach beyond these.
WALLS = frozenset("article aside body div footer form header html main nav ol section table ul".split())

#: Cues of boilerplate and of content: names in class, id and role, or their first or last words.
BOILER_TAGS = frozenset("nav footer aside form button menu dialog fieldset".split())
HARD = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox banner breadcrumb breadcrumbs comment comments comentarios commentaires cookie cookies "
    "consent copyright disclaimer disqus footer gdpr kommentare login masthead menu modal nav navbar navigation newsletter "
    "paywall popup promoted recommended replies reply respond sharing shoutbox sidebar "
    "signup sponsor sponsored subscribe subscription teaser toc toolbar overlay pager pagination contentinfo complementary".split()
)
#: Boilerplate where they are the whole name; inside a longer one themes put them on articles as well.
AMBIGUOUS = frozenset("alert discussion notice notices promo promotion related search share social tags widget widgets".split())
#: These hold readers' words, however many.
READERS = frozenset("comment comments comentarios commentaires disqus kommentare replies reply respond shoutbox".split())
SOFT = frozenset("header head top bottom side meta tools info aside legal hidden".split())
GOOD = frozenset("article articlebody body content entry main post story text".split())
#: First words of names that describe a whole layout or a text's subject, not its part on the page; words that do so anywhere.
LAYOUT = frozenset("is layout grid row category tag type status format single theme".split())
BESIDE = frozenset("with has no without".split())
#: Share of the page's long unlinked text that makes an element its main text whatever its name.
MOST = 0.8

#: Classifier weights and smoothness capacities.
W_HARD, W_TAG, W_SOFT, W_WORD, W_ARTICLE, W_GOOD, W_HEADING, W_P, W_LINK, W_SHORT, W_LONG, BIAS = -7.0, -7.0, -2.5, -1.0, 4.0, 1.5, 0.5, 0.8, -3.0, -0.8, 1.2, -0.6
ADJACENT, PARENT = 0.6, 0.5


class Block:
    __slots__ = ("element", "linked", "parts")

    def __init__(self, element: int):
        self.element, self.parts, self.linked = element, [], 0


def _attributes(source: str) -> dict[str, str]:
    return {m[0].lower(): (m[1] or m[2] or m[3]) for m in _ATTR.findall(source)}


def _named(names: list[str]) -> tuple[float, bool]:
    """(score of an element's names, whether readers' words stand in it)."""
    score, good = 0.0, False
    for name in names:
        words = _TOKENS.findall(name)
        # BEM: the block's part after the last double sign is a variant.
        words = _TOKENS.findall(re.split(r"--", name)[0]) or words
        if not words:
            continue
        ends = {words[0], words[-1]}
        if len(words) == 1 and (words[0] in HARD or words[0] in AMBIGUOUS):
            return W_HARD, words[0] in READERS
        if words[0] in LAYOUT or BESIDE.intersection(words):
            continue
        if ends & HARD:
            return W_HARD, bool(ends & READERS)
        good |= bool(ends & GOOD)
        score = min(score, W_SOFT if ends & SOFT else W_WORD if ends & AMBIGUOUS else 0.0)
    return (W_GOOD if good else score), False


def _cue(tag: str, attrs: str) -> tuple[float, bool, bool]:
    """(score of the element's own cues, whether its text is hidden, whether only its name speaks against it)."""
    score = W_TAG if tag in BOILER_TAGS else W_SOFT if tag == "header" else W_ARTICLE if tag in ("article", "main") else 0.0
    if not attrs or attrs.isspace():
        return score, False, False
    a = _attributes(attrs)
    hidden = "hidden" in a or a.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", ""), re.I) is not None
    if tag in ("html", "body"):
        return score, hidden, False
    named, readers = _named(" ".join(a.get(x) or "" for x in ("class", "id", "role", "itemprop")).lower().split())
    if named == W_HARD:
        return min(score, W_HARD), hidden, score >= 0 and not readers
    if named > 0:
        return (max(score, named) if score >= 0 else score), hidden, False
    # A soft word takes something off an article, and is all there is elsewhere.
    return (score + named if score > 0 else min(score, named)), hidden, False


def blocks(page: str) -> tuple[list[Block], list[tuple[str, int, float, bool]]]:
    """Text blocks, and the elements as (tag, parent, own cue, whether the cue is only a name)."""
    elements: list[tuple[str, int, float, bool]] = [("", -1, 0.0, False)]
    stack = [(0, "", False, 0)]  # (element, tag, hidden, element that holds its blocks)
    opened: Counter[str] = Counter()  # tags on the stack
    out: list[Block] = []
    current: Block | None = None
    links = 0
    at, end = 0, len(page)

    def add(text: str) -> None:
        nonlocal current
        if stack[-1][2] or not text:
            return
        if current is None:
            if text.isspace():
                return
            current = Block(stack[-1][3])
            out.append(current)
        if "&" in text:
            text = _html.unescape(text)
        current.parts.append(text)
        if links:
            current.linked += len(text)

    def close_from(k: int) -> None:
        nonlocal links
        for _, t, _, _ in stack[k:]:
            opened[t] -= 1
            links -= t == "a"
        del stack[k:]

    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:  # comments, declarations, broken tags
            continue
        tag = tag.lower()
        if m[1]:  # an end tag closes up to its start tag
            if tag not in INLINE:
                current = None
            for k in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[k][1] == tag:
                    close_from(k)
                    break
                if stack[k][1] in WALLS and tag not in WALLS:
                    break
            continue
        if tag in RAW:
            current = None if tag not in INLINE else current
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at) if not m[3].rstrip().endswith("/") else None
            if tag == "head":
                body = re.compile(r"<(?:body|article|main|div|p|h1)\b", re.I).search(page, at)
                at = close.end() if close and (not body or close.start() < body.start()) else body.start() if body else at
            elif close:
                at = close.end()
            elif tag in ("script", "style", "noscript", "template", "textarea", "title"):
                at = end
            continue
        if tag in VOID:
            if tag not in INLINE:
                current = None
            continue
        if tag not in INLINE:
            current = None
            shut = CLOSES.get(tag)
            ends = opened["p"] or shut and any(opened[t] for t in shut)
            for k in range(len(stack) - 1, 0, -1) if ends else ():
                t = stack[k][1]
                if t == "p" or shut and t in shut:  # an open paragraph ends where a block begins
                    close_from(k)
                    if not shut:
                        break
                elif t in WALLS:
                    break
        elif tag == "a":
            links += 1
        cue, hidden, by_name = _cue(tag, m[3])
        elements.append((tag, stack[-1][0], cue, by_name))
        opened[tag] += 1
        own = len(elements) - 1
        stack.append((own, tag, hidden or stack[-1][2], stack[-1][3] if tag in INLINE else own))
    return out, elements


def _main_whatever_its_name(found: list[Block], elements: list[tuple], texts: list[str]) -> set[int]:
    """Elements with a boilerplate name that hold nearly all of the page's long unlinked text."""
    named = [e for e, x in enumerate(elements) if x[3]]
    if not named:
        return set()
    weight = [0] * len(elements)
    for b, text in zip(found, texts, strict=True):
        if len(text) >= 100 and 2 * b.linked < len(text):
            weight[b.element] += len(text)
    for e in range(len(elements) - 1, 0, -1):  # parents come before their children
        weight[elements[e][1]] += weight[e]
    return {e for e in named if weight[e] and weight[e] >= MOST * weight[0]}


def _context(elements: list[tuple[str, int, float, bool]], pardoned: set[int]) -> list[float]:
    """The cue that holds in each element: the innermost decides, but what stands
    in a boilerplate element stays boilerplate."""
    held = []
    for e, (tag, parent, own, _) in enumerate(elements):
        if e in pardoned:
            own = W_ARTICLE if tag in ("article", "main") else 0.0
        above = held[parent] if parent >= 0 else 0.0
        if above <= W_SOFT - 1 or own == 0.0:
            held.append(above)
        elif own < 0 or above <= 0:
            held.append(own if own <= W_SOFT else max(own, above))
        else:
            held.append(max(own, above))
    return held


def scores(found: list[Block], elements: list[tuple[str, int, float, bool]], texts: list[str]) -> list[float]:
    held = _context(elements, _main_whatever_its_name(found, elements, texts))
    out = []
    for b, text in zip(found, texts, strict=True):
        tag = elements[b.element][0]
        words = text.count(" ") + 1
        s = BIAS + held[b.element]
        s += W_LINK * min(1.0, b.linked / max(1, len(text)))
        s += W_LONG * min(2.0, words / 20) if words >= 8 else W_SHORT * (8 - words) / 8
        s += W_P if tag in ("p", "blockquote", "pre") else W_HEADING if tag in ("h1", "h2", "h3", "h4", "h5", "h6") else 0.0
        out.append(s)
    return out


def min_cut(terminal: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source's side of a minimum cut (a node that costs the same on either side is not)."""
    n = len(terminal)
    t = list(terminal)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        if a != b:
            near[a][b] = near[a].get(b, 0.0) + w
            near[b][a] = near[b].get(a, 0.0) + w
    side: list[bool | None] = [None] * n
    todo = list(range(n))
    while todo:  # nodes that no neighbour can turn
        v = todo.pop()
        if side[v] is not None or abs(t[v]) <= sum(near[v].values()):
            continue
        side[v] = t[v] > 0
        for u, w in near[v].items():
            del near[u][v]
            t[u] += w if side[v] else -w
            todo.append(u)
        near[v] = {}
    rest = [v for v in range(n) if side[v] is None]
    if rest:
        reached = max_flow({v: t[v] for v in rest}, {v: near[v] for v in rest})
        for v in rest:
            side[v] = v in reached
    return [bool(x) for x in side]


def max_flow(terminal: dict[int, float], near: dict[int, dict[int, float]]) -> set[int]:
    """Nodes still reached from the source after a maximum flow (rounds of blocking flows over levels)."""
    tiny = 1e-9
    source = {v: c for v, c in terminal.items() if c > tiny}
    sink = {v: -c for v, c in terminal.items() if c < -tiny}
    residual = {v: dict(e) for v, e in near.items()}
    arcs = {v: list(e) for v, e in residual.items()}
    while True:
        level = {v: 0 for v, c in source.items() if c > tiny}
        starts, queue, ends = list(level), list(level), False
        for v in queue:
            ends = ends or sink.get(v, 0.0) > tiny
            for u, c in residual[v].items():
                if c > tiny and u not in level:
                    level[u] = level[v] + 1
                    queue.append(u)
        if not ends:
            return set(level)
        at = dict.fromkeys(level, 0)  # the next arc to try of each node
        for start in starts:
            path = [start]
            while path and source[start] > tiny:
                v = path[-1]
                if sink.get(v, 0.0) > tiny:
                    steps = list(zip(path, path[1:], strict=False))
                    push = min(source[start], sink[v], min((residual[a][b] for a, b in steps), default=source[start]))
                    source[start] -= push
                    sink[v] -= push
                    for a, b in steps:
                        residual[a][b] -= push
                        residual[b][a] += push
                    full = next((k for k, (a, b) in enumerate(steps) if residual[a][b] <= tiny), None)
                    if full is not None:
                        del path[full + 1 :]
                    continue
                own = arcs[v]
                while at[v] < len(own):
                    u = own[at[v]]
                    if residual[v][u] > tiny and level.get(u, -1) == level[v] + 1:
                        path.append(u)
                        break
                    at[v] += 1
                else:  # nothing gets any further from here
                    path.pop()
                    if path:
                        at[path[-1]] += 1


def extract(page: str | None) -> str:
    if not page:
        return ""
    found, elements = blocks(page)
    texts = [" ".join("".join(b.parts).split()) for b in found]
    keep = [k for k, x in enumerate(texts) if x]
    if not keep:
        return ""
    found, texts = [found[k] for k in keep], [texts[k] for k in keep]
    # Nodes: the blocks, then the elements that hold text, up to the root.
    node: dict[int, int] = {}
    edges = [(k, k + 1, ADJACENT) for k in range(len(found) - 1)]
    for k, b in enumerate(found):
        below, e = k, b.element
        while e >= 0:
            new = e not in node
            own = node.setdefault(e, len(found) + len(node))
            edges.append((below, own, PARENT))
            if not new:
                break
            below, e = own, elements[e][1]
    side = min_cut(scores(found, elements, texts) + [0.0] * len(node), edges)
    return " ".join(x for x, content in zip(texts, side, strict=False) if content)


def extract_text(pages: DataFrame, html: str = "html", to: str = "text") -> DataFrame:
    """``pages`` with the main text of each."""

    @F.pandas_udf(T.StringType())
    def main_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([extract(x if isinstance(x, str) else None) for x in batch], dtype=object)

    return in_small_batches(pages).withColumn(to, main_text(F.col(html)))


def op10_html_text(pages: DataFrame) -> DataFrame:
    out = extract_text(pages.select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
