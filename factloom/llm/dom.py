"""A tolerant HTML parser to flat arrays of elements, and features of every element.

Comments, doctypes, scripts, styles and other content that is never shown are dropped while parsing. End tags that authors leave
out are implied; an end tag without a start is ignored.
"""

from __future__ import annotations

import html as entities
import re
import zlib

import numpy as np

_NEVER = r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|title|iframe)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
_TOKEN = re.compile(
    _NEVER + r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>",
    re.S | re.I,
)
#: Elements that are dropped with their content, but only where they have an end tag.
_DROPPED = re.compile(_NEVER + r"|<(/?)(svg|object|select)(?=[\s/>])([^>]*)>", re.S | re.I)
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark output q ruby rp rt s samp small span strike strong sub sup time tt u var wbr img br".split())
#: Start tag: the open elements that it closes, up to a boundary.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
_ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: Hashed tokens whose log-odds are learned.
TOKENS = 1 << 15
#: Hashed flags: of an element's own tokens, and as many of its ancestors'.
FLAGS = 512


def bucket(token: str) -> int:
    return zlib.crc32(token.encode()) % TOKENS


def _signs(tag: str, parts: tuple[str, ...]) -> list[str]:
    """The tokens of an element: its tag, the parts of its attributes, and the beginnings of longer parts."""
    return [f"<{tag}", *parts, *(f"^{p[:k]}" for p in parts for k in (5, 7) if len(p) > k)]


def _dropped(source: str) -> dict[int, int]:
    """Start to end of each svg, object and select that has an end tag of its own. A self-closed svg is empty."""
    found, open_ = {}, {"svg": [], "object": [], "select": []}
    for m in _DROPPED.finditer(source):
        name = (m.group(3) or "").lower()
        if not name or name == "svg" and m.group(4).endswith("/"):
            continue
        if not m.group(2):
            open_[name].append(m.start())
        elif open_[name]:
            found[open_[name].pop()] = m.end()
    return found


class Page:
    """Elements of a page in document order; element 0 is the root. ``text`` holds (element, string) in page order."""

    __slots__ = ("tag", "parent", "depth", "tokens", "text", "end")

    def __init__(self, source: str):
        self.tag, self.parent, self.depth, self.tokens, self.end = ["#root"], [-1], [0], [()], [0]
        self.text: list[tuple[int, str]] = []
        stack, at, dropped = [0], 0, _dropped(source)
        while m := _TOKEN.search(source, at):
            if m.start() > at:
                self.text.append((stack[-1], source[at : m.start()]))
            at = dropped.get(m.start(), m.end())
            if m.start() in dropped:
                continue
            name = m.group(3) or m.group(6)
            if not name:
                continue
            name = name.lower()
            if m.group(2) or m.group(5):
                self._close(stack, name)
            else:
                self._open(stack, name, m.group(4) or m.group(7) or "")
        if at < len(source):
            self.text.append((stack[-1], source[at:]))
        n = len(self.tag)
        self.end = [i + 1 for i in range(n)]
        for i in range(n - 1, 0, -1):
            self.end[self.parent[i]] = max(self.end[self.parent[i]], self.end[i])

    def _open(self, stack: list[int], name: str, attributes: str) -> None:
        if name in _ENDS_P:
            for k in range(len(stack) - 1, 0, -1):
                t = self.tag[stack[k]]
                if t == "p":
                    del stack[k:]
                    break
                if t not in _INLINE:
                    break
        if name in _CLOSES:
            ends, boundary = _CLOSES[name]
            for k in range(len(stack) - 1, 0, -1):
                t = self.tag[stack[k]]
                if t in boundary:
                    break
                if t in ends:
                    del stack[k:]
        i = len(self.tag)
        self.tag.append(name)
        self.parent.append(stack[-1])
        self.depth.append(len(stack))
        found = () if "=" not in attributes else tuple(p.lower() for a in _ATTRIBUTE.finditer(attributes) for p in _PART.findall(a.group(2) or a.group(3) or a.group(4) or ""))
        self.tokens.append(found)
        if name not in _VOID and not attributes.endswith("/"):
            stack.append(i)
        elif name in ("br", "hr"):
            self.text.append((i, " "))

    def _close(self, stack: list[int], name: str) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if self.tag[stack[k]] == name:
                del stack[k:]
                return
            if name in _INLINE and self.tag[stack[k]] not in _INLINE:
                return

    def lengths(self) -> np.ndarray:
        """Characters of each element's own text, without white space at the ends of its pieces."""
        n = np.zeros(len(self.tag))
        for i, t in self.text:
            n[i] += len(t.strip())
        return n

    def units(self) -> list[int]:
        """The element that decides for each one's own text: itself, but for an inline element without a name the one around it."""
        at = list(range(len(self.tag)))
        for i in range(1, len(at)):
            if self.tag[i] in _INLINE and not self.tokens[i]:
                at[i] = at[self.parent[i]]
        return at

    def blocks(self, chosen: np.ndarray) -> list[str]:
        """Texts of the blocks among the chosen elements' own text, in page order."""
        tag, parent = self.tag, self.parent
        block = [0] * len(tag)
        for i in range(1, len(tag)):
            block[i] = block[parent[i]] if tag[i] in _INLINE else i
        out, now = [], -1
        for i, t in self.text:
            if block[i] != now:
                out.append([])
                now = block[i]
            if chosen[i]:
                out[-1].append(t)
        texts = (" ".join(entities.unescape("".join(p)).split()) for p in out if p)
        return [t for t in texts if t]

    def numbers(self) -> np.ndarray:
        """A row of NUMERIC features for each element."""
        n = len(self.tag)
        own = self.lengths()
        parent, end = np.array(self.parent), np.array(self.end)
        commas = np.zeros(n)
        for i, t in self.text:
            commas[i] += t.count(",") + t.count(". ")
        is_ = lambda *names: np.array([t in names for t in self.tag], float)
        link = is_("a")
        inside_link = np.zeros(n, bool)
        for i in range(1, n):
            inside_link[i] = self.tag[i] == "a" or inside_link[parent[i]]
        sub = lambda v: (c := np.r_[0, np.cumsum(v)])[end] - c[:n]
        chars, links, tags = sub(own), sub(own * inside_link), (end - np.arange(n)).astype(float)
        paragraphs, controls, items, marks = sub(is_("p")), sub(is_("input", "button", "form", "label", "textarea", "select")), sub(is_("li")), sub(commas)
        kids = np.bincount(parent[1:], minlength=n).astype(float) if n > 1 else np.zeros(n)
        place = np.zeros(n)
        seen = np.zeros(n)
        for i in range(1, n):
            place[i] = seen[parent[i]]
            seen[parent[i]] += 1
        up = np.maximum(parent, 0)
        total = max(chars[0], 1.0)
        before = np.r_[0, np.cumsum(own)][:n]
        # what paragraphs beside an element hold
        beside = np.bincount(up[1:], weights=(chars * is_("p"))[1:], minlength=n)[up] - chars * is_("p")
        return np.column_stack(
            [
                np.array(self.depth), np.log1p(chars), chars / total, chars / np.maximum(chars[up], 1), links / np.maximum(chars, 1), links[up] / np.maximum(chars[up], 1), np.log1p(chars / tags), np.log1p(tags),
                np.log1p(paragraphs), np.log1p(sub(link)), np.log1p(items), np.log1p(controls), marks / np.maximum(chars, 1) * 100, kids, kids[up], place / np.maximum(kids[up], 1), before / total, np.log1p(own), paragraphs / tags,
                np.log1p(np.maximum(beside, 0)), np.full(n, np.log1p(total)), np.full(n, np.log1p(n)),
            ]
        ).astype(np.float32)

    def masks(self) -> tuple[list[int], list[int]]:
        """The flags of each element's tokens and of its ancestors', as bits of an integer. Equal ones are one object."""
        known: dict[tuple, int] = {}
        own, above, below = [], [], []
        for i, (tag, parent) in enumerate(zip(self.tag, self.parent, strict=True)):
            key = (tag, self.tokens[i])
            if key not in known:
                known[key] = 0
                for t in _signs(tag, self.tokens[i]):
                    known[key] |= 1 << bucket(t) % FLAGS
            own.append(known[key])
            above.append(below[parent] if i else 0)
            both = above[i] | own[i]
            below.append(above[i] if both == above[i] else both)
        return own, above


    def signs(self, i: int) -> list[str]:
        return _signs(self.tag[i], self.tokens[i])

    def names(self, odds: np.ndarray) -> np.ndarray:
        """A row of NAMES features for each element: what the log-odds of tokens say of it, its ancestors and its text."""
        n = len(self.tag)
        known: dict[tuple, tuple[float, float]] = {}
        least, most, above_least, above_most = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
        for i, (tag, parent) in enumerate(zip(self.tag, self.parent, strict=True)):
            key = (tag, self.tokens[i])
            if key not in known:
                v = [float(odds[bucket(t)]) for t in _signs(tag, self.tokens[i])]
                known[key] = min(v), max(v)
            least[i], most[i] = known[key]
            if i:
                above_least[i], above_most[i] = min(above_least[parent], least[parent]), max(above_most[parent], most[parent])
        parent, end, own = np.maximum(np.array(self.parent), 0), np.array(self.end), self.lengths()
        sub = lambda v: (c := np.r_[0, np.cumsum(v)])[end] - c[:n]
        path = np.minimum(least, above_least)
        bad, chars = sub(own * (path < -1)), np.maximum(sub(own), 1)
        return np.column_stack([least, most, least[parent], most[parent], above_least, above_most, path, bad / chars, (bad[0] - bad) / max(own.sum(), 1)]).astype(np.float32)


def flags(own: list[int], above: list[int], used: np.ndarray | None = None) -> np.ndarray:
    """0/1 flags of some elements: FLAGS of their own and FLAGS of their ancestors, or those of them that are used."""
    def bits(masks: list[int], columns: np.ndarray | slice) -> np.ndarray:
        place: dict[int, int] = {}
        at = [place.setdefault(m, len(place)) for m in masks]
        packed = np.frombuffer(b"".join(m.to_bytes(FLAGS // 8, "little") for m in place), np.uint8).reshape(len(place), -1)
        if isinstance(columns, slice):
            return np.unpackbits(packed, axis=1, bitorder="little")[at]
        return ((packed[:, columns >> 3] >> (columns & 7).astype(np.uint8)) & 1)[at]

    if used is None:
        return np.hstack([bits(own, slice(None)), bits(above, slice(None))])
    return np.hstack([bits(own, used[used < FLAGS]), bits(above, used[used >= FLAGS] - FLAGS)])


NUMERIC, NAMES = 22, 9
