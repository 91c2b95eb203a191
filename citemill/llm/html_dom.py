"""Pages as lists of blocks, and what is known about each block."""

from __future__ import annotations

import re
from collections import defaultdict
from html import unescape

import numpy as np

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"(?:^|\s)(class|id|role|style|itemprop|aria-hidden|aria-label|hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I
)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden|aria-hidden=\"?true|\bhidden=", re.I)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table"
    " tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Their text is never part of what a page says. What is inside the first kind is no markup, and without
# a closing tag they go on to the end of the page.
RAW = frozenset("script style iframe title textarea".split())
# Formulas and what stands in for an object are text, but not a formula's source in another notation.
SILENT = frozenset(
    "template noscript svg annotation annotation-xml button select option canvas audio video datalist".split()
)
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"},
}
_SCOPE = frozenset("table ul ol dl div section article body".split())
_END = {t: re.compile(f"</{t}\\s*>", re.I) for t in RAW}

# What attributes and tags say, one bit each; a block has those of all that hold it, too.
_SAYS = (
    ("good", r"article|content|post|entry|story|main|text|news|blog|page ?body|prose"),
    ("menu", r"nav|navbar|navigation|menu|breadcrumbs?|toolbar|tabs|pagination|pager|skip|toc"),
    ("ad", r"ads?|advert|advertisement|banner|sponsor|sponsored|promo|promotion|doubleclick|outbrain|taboola"),
    ("comment", r"comments?|replies|reply|respond|disqus|discussion|feedback|reviews?"),
    ("notice", r"cookies?|consent|notice|alert|popup|modal|overlay|newsletter|subscribe|gdpr|paywall|toast"),
    ("side", r"sidebar|side|aside|related|widget|share|sharing|social|recommended|trending|popular|tags?|more"),
    ("foot", r"footer|foot|copyright|legal|colophon|imprint|sitemap"),
    ("head", r"header|masthead|logo|brand|topbar|site ?title|hero"),
    ("form", r"form|login|search|signup|register|contact|captcha"),
)
_WORDS = [(1 << k, re.compile(rf"(?:^|[^a-z])(?:{words})(?=$|[^a-z])")) for k, (_, words) in enumerate(_SAYS)]
_N = len(_SAYS)
HIDDEN, ARTICLE = 1 << _N, 1 << (_N + 1)
_TAG_BITS = {
    "article": ARTICLE, "main": ARTICLE, "nav": 1 << (_N + 2), "menu": 1 << (_N + 2), "header": 1 << (_N + 3),
    "footer": 1 << (_N + 4), "aside": 1 << (_N + 5), "form": 1 << (_N + 6), "fieldset": 1 << (_N + 6),
    "dialog": 1 << (_N + 7), "figure": 1 << (_N + 8), "table": 1 << (_N + 9),
}
_BITS = _N + 10
_KIND = {t: 1 for t in ("p", "pre", "blockquote")} | {f"h{k}": 2 for k in range(1, 7)}
_KIND |= {t: 3 for t in ("li", "dt", "dd")} | {t: 4 for t in ("td", "th", "caption")}


def _said(attributes: str, seen: dict[str, int]) -> int:
    bits = seen.get(attributes)
    if bits is None:
        values = [(a.lower(), (v or "").strip("\"'")) for a, v in _ATTRIBUTE.findall(attributes)]
        named = " ".join(v for a, v in values if a not in ("style", "hidden", "aria-hidden"))
        # Words in a name may be joined by capitals.
        named = re.sub(r"([a-z])([A-Z])", r"\1 \2", named).lower()
        bits = sum(bit for bit, words in _WORDS if words.search(named))
        if _HIDDEN.search(" ".join(f"{a}={v}" for a, v in values)):
            bits |= HIDDEN
        if len(seen) < 10_000:
            seen[attributes] = bits
    return bits


def _after_raw(html: str, at: int, name: str) -> int:
    stop = _END[name].search(html, at)
    return stop.end() if stop else len(html)


def _silent_ends(html: str, at: int, around: list[str], name: str) -> dict[int, int]:
    """Where silent elements end that are closed, by the place after their opening tags.

    Looks at the page from the element ``name`` on that opens right before ``at``, inside the blocks
    ``around``. An element is left open, and not listed, if a block around it closes first or its
    closing tag belongs to another one.
    """
    stack: list[tuple[str, int]] = []
    places: dict[str, list[int]] = defaultdict(list)
    ends = {}

    def opened(name: str, start: int) -> None:
        places[name].append(len(stack))
        stack.append((name, start))

    for block in around:
        opened(block, -1)
    opened(name, at)
    while found := _TOKEN.search(html, at):
        at = found.end()
        end, name, attributes = found.groups()
        name = name and name.lower()
        if name in RAW:
            if not end and not attributes.endswith("/"):
                at = _after_raw(html, at, name)
        elif name not in SILENT and (name not in BLOCKS or name in VOID):
            continue
        elif not end:
            if name in BLOCKS or not attributes.endswith("/"):
                opened(name, at)
        elif places[name]:
            k = places[name][-1]
            if name == "p" and any(places[t] and places[t][-1] > k for t in SILENT):
                continue
            if name in SILENT:
                ends[stack[k][1]] = at
            while len(stack) > k:
                places[stack.pop()[0]].pop()
    return ends


class Blocks:
    """Blocks of many pages, in columns; the children of a block come after it.

    A leaf is a run of text that no block interrupts; other blocks are the elements around.
    """

    def __init__(self, mark: str = ""):
        self.mark = mark
        self.pages: list[int] = []  # first block of each page
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.kind: list[int] = []  # of the element; leaves have that of their owner
        self.own: list[int] = []
        self.bits: list[int] = []
        self.leaf: list[str | None] = []
        self.links: list[int] = []
        self.marked: list[bool] = []
        self._seen: dict[str, int] = {}

    def _add(self, parent: int, kind: int, own: int, leaf: str | None, links: int, marked: bool) -> int:
        top = parent < 0
        self.parent.append(parent)
        self.depth.append(0 if top else self.depth[parent] + 1)
        self.kind.append(kind)
        self.own.append(own)
        self.bits.append(own if top else own | self.bits[parent])
        self.leaf.append(leaf)
        self.links.append(links)
        self.marked.append(marked)
        return len(self.parent) - 1

    def add_page(self, html: str) -> None:
        self.pages.append(len(self.parent))
        stack = [("", self._add(-1, 0, 0, None, 0, False))]
        text: list[str] = []
        # Blocks around a silent element that is never closed, 0 outside of one: its text goes up to where a
        # block opens or one around it closes.
        state = {"link": 0, "links": 0, "silent": 0}
        ends: dict[int, int] | None = None

        def flush() -> None:
            if text:
                words = "".join(text).split()
                text.clear()
                if words:
                    said = " ".join(words)
                    marked = bool(self.mark) and self.mark in said
                    said = said.replace(self.mark, "") if marked else said
                    owner = stack[-1][1]
                    links = min(state["links"], len(said))
                    self._add(owner, self.kind[owner], 0, said, links, marked)
            state["links"] = 0

        def say(part: str) -> None:
            if part and not state["silent"]:
                part = unescape(part) if "&" in part else part
                text.append(part)
                if state["link"]:
                    state["links"] += len(part.strip())

        def close(names: set[str], until: frozenset[str]) -> None:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in names:
                    flush()
                    del stack[k:]
                    if k < state["silent"]:
                        state["silent"] = 0
                    return
                if stack[k][0] in until:
                    return

        at = 0
        while found := _TOKEN.search(html, at):
            say(html[at : found.start()])
            at = found.end()
            end, name, attributes = found.groups()
            if name is None:
                continue
            name = name.lower()
            if name == "a":
                state["link"] = 0 if end else 1
            elif name == "br":
                text.append(" ")
            elif name in RAW:
                if not end and not attributes.endswith("/"):
                    at = _after_raw(html, at, name)
            elif name in SILENT:
                if not end and not attributes.endswith("/"):
                    if ends is None:
                        ends = _silent_ends(html, at, [block for block, _ in stack[1:]], name)
                    if at in ends:
                        at = ends[at]
                    else:
                        state["silent"] = state["silent"] or len(stack)
            elif name not in BLOCKS:
                continue
            elif end:
                close({name}, frozenset())
            else:
                state["silent"] = 0
                close({"p"}, _SCOPE)
                if name in _CLOSES:
                    close(_CLOSES[name], _SCOPE - {name} if name != "tr" else frozenset({"table"}))
                flush()
                if name not in VOID:
                    own = _TAG_BITS.get(name, 0) | (_said(attributes, self._seen) if attributes else 0)
                    kind = _KIND.get(name, 5)
                    stack.append((name, self._add(stack[-1][1], kind, own, None, 0, False)))
        say(html[at:])
        flush()

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """Which blocks are judged, and a row of numbers for each of those.

        Judged are the leaves, and elements that hold other elements. Numbers cover the tag,
        depth, what attributes and holders say, the text, the density of text and links in
        the subtree, and how a block compares with its siblings, its parent and its page.
        """
        n = len(self.parent)
        parent, depth = np.array(self.parent), np.array(self.depth)
        leaf = np.array([x is not None for x in self.leaf])
        texts = [x or "" for x in self.leaf]
        chars = np.array([len(x) for x in texts], np.float32)
        words = np.array([x.count(" ") + 1 if x else 0 for x in texts], np.float32)
        marks = np.array([x.count(".") + x.count(",") + x.count("?") + x.count("!") for x in texts], np.float32)
        kind = np.array(self.kind)
        page = np.repeat(np.arange(len(self.pages)), np.diff([*self.pages, n]))
        sums = np.stack(
            [chars, words, marks, np.array(self.links, np.float32), ~leaf,
             (kind == 1) & leaf, (kind == 3) & leaf, (kind == 2) & leaf], axis=1
        ).astype(np.float32)
        before = np.cumsum(chars) - chars
        before -= before[np.array(self.pages, int)][page] if n else 0
        for d in range(int(depth.max(initial=0)), 0, -1):
            at = np.flatnonzero(depth == d)
            np.add.at(sums, parent[at], sums[at])
        size = sums[:, 0]
        up = np.maximum(parent, 0)
        holds = np.bincount(parent[(parent >= 0) & ~leaf], minlength=n) > 0
        order = np.lexsort((np.arange(n), parent))
        first = np.ones(n, bool)
        first[1:] = parent[order][1:] != parent[order][:-1]
        start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        number = np.bincount(up, minlength=n).astype(np.float32)[up]
        place, previous, following = np.zeros(n, np.float32), np.zeros(n, np.float32), np.zeros(n, np.float32)
        place[order] = np.arange(n) - start
        previous[order[1:]] = np.where(first[1:], 0, size[order[:-1]])
        following[order[:-1]] = np.where(first[1:], 0, size[order[1:]])
        whole = size[np.array(self.pages, int)][page] if n else size
        inherited, own = np.array(self.bits), np.array(self.own)
        own_kind = [kind == k for k in range(1, 6)]
        columns = [
            leaf, *own_kind, depth, np.log1p(size), np.log1p(sums[:, 1]), size / np.maximum(sums[:, 1], 1),
            sums[:, 2] / np.maximum(sums[:, 1], 1), sums[:, 3] / np.maximum(size, 1),
            size / (1 + sums[:, 4]), np.log1p(sums[:, 4]), np.log1p(sums[:, 5]), np.log1p(sums[:, 6]),
            np.log1p(sums[:, 7]), place / np.maximum(number - 1, 1), np.log1p(number),
            size / np.maximum(size[up], 1), size / np.maximum(whole, 1), before / np.maximum(whole, 1),
            np.log1p(previous), np.log1p(following), sums[up, 3] / np.maximum(size[up], 1),
            np.log1p(sums[up, 5]), np.log1p(whole),
            *[(inherited >> k) & 1 for k in range(_BITS)], *[(own >> k) & 1 for k in range(_N + 2)],
        ]
        judged = np.flatnonzero(leaf | holds)
        return judged, np.stack([np.asarray(c, np.float32)[judged] for c in columns], axis=1)

    def decode(self, judged: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Blocks that are kept, so that whatever is kept lies in what is kept.

        Scores are log odds. Of all such choices the likeliest is taken: a block is worth its
        own score and what its children are worth, where that is above 0.
        """
        worth = np.zeros(len(self.parent))
        worth[judged] = scores
        value, parent = worth.tolist(), self.parent
        for k in range(len(value) - 1, -1, -1):
            if value[k] > 0 and parent[k] >= 0:
                value[parent[k]] += value[k]
        kept = [False] * len(value)
        for k, p in enumerate(parent):
            kept[k] = (p < 0 or kept[p]) and (value[k] > 0 or p < 0)
        return np.array(kept, bool)

    def texts(self, kept: np.ndarray) -> list[str]:
        """The kept leaves of each page, a line each."""
        ends = [*self.pages[1:], len(self.parent)]
        return [
            "\n".join([self.leaf[k] for k in range(a, b) if kept[k] and self.leaf[k] is not None])
            for a, b in zip(self.pages, ends)
        ]
