"""Main-text extraction from HTML by gradient-boosted trees over DOM elements.

Every element gets features: size and density of its subtree, link share, depth, place among its siblings, hashed tokens of its
tag and attributes and of its ancestors', and the log-odds that these tokens have on the training pages.  Boosted trees, trained here on generated pages whose
parts are known, give the log-odds that an element is main content.  The generated pages vary in their containers (or have none), in the blocks of
the article, and in what stands around it and inside it.  Decoding goes over the tree once from the leaves: an element is
taken whole, dropped whole, or split into its own text and its children, whichever scores best, so no
verdict contradicts that of an ancestor or descendant.

Blocks are the texts of block elements; character references are decoded, white space inside a block becomes one blank, and blocks
are joined by line feeds in page order.  Defined results: null, empty and textless pages give an empty text; a page without any element is its text; repeated rows
give the same text; an empty table gives an empty result; markup that never ends is read as far as it goes; a page of any size is read whole: a worker
holds its elements, and scores _CHUNK of them at a time. Input columns named as an output are replaced.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from factloom.llm import boosting
from factloom.llm.common import annotate
from factloom.llm.dom import NAMES, NUMERIC, TOKENS, Page, bucket, flags

TRAINING_PAGES, SEED = 2_000, 41
#: Log-odds are clipped here, and a split costs this much per element: whole verdicts are preferred if equal.
_CLIP, _SPLIT = 6.0, 0.5
#: Elements that are scored at a time.
_CHUNK = 16_000
ROUNDS, DEPTH = 60, 5
#: A token of fewer elements of the generated pages says nothing.
LEAST = 5

# What authors name the parts of a page: of the article, and of the rest by its kind.
_ARTICLE = "content article post body story entry text prose main single page markdown section copy reader full news blog doc document".split()
_REST = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs topnav toolbar pager pagination tabs links skip toc",
    "header": "header masthead topbar banner branding logo site top",
    "footer": "footer bottom colophon copyright legal terms imprint",
    "aside": "aside sidebar side widget related recommended recommendations more trending popular latest teaser promo rail complementary archive",
    "notice": "cookie notice consent gdpr alert banner popup modal overlay dialog message paywall warning",
    "ad": "ad ads advert advertisement sponsor sponsored promotion promo outbrain taboola adsense commercial",
    "form": "form search login signup subscribe newsletter contact subscription register poll",
    "comments": "comments comment disqus thread reply replies respond discussion responses reactions feedback livefyre remarks",
    "share": "share social sharing follow tags tag likes facebook twitter",
}
_TAGS = {"menu": ["nav", "ul", "div", "ol"], "header": ["header", "div"], "footer": ["footer", "div"], "aside": ["aside", "div", "section"], "notice": ["div", "section"], "ad": ["div", "aside", "ins"], "form": ["form", "div"], "comments": ["section", "div", "ol", "ul"], "share": ["div", "ul"]}
_BARE = {"nav", "header", "footer", "aside", "form"}  # tags that say it without a name


class _Writer:
    """Pages of invented words whose parts are known."""

    def __init__(self, rng: random.Random):
        self.rng = rng

    def word(self) -> str:
        return "".join(self.rng.choice(["an", "ter", "lo", "mi", "sen", "the", "ra", "vi", "os", "und"]) for _ in range(self.rng.randint(1, 3)))

    def text(self, a: int, b: int) -> str:
        r = self.rng
        return " ".join(self.word() + ("," if r.random() < 0.06 else "." if r.random() < 0.08 else "") for _ in range(r.randint(a, b)))

    def named(self, words: list[str], bare: bool) -> str:
        """An attribute that holds a name of the kind, or none."""
        r = self.rng
        if bare and r.random() < 0.4:
            return ""
        names = [r.choice(words)]
        if r.random() < 0.4:
            names.append(r.choice([*words, "wrap", "box", "inner", "list", "block", "area", "container", "col", "row", "1", "2", "m", "item", self.word()]))
        if r.random() < 0.3:
            names.reverse()
        value = r.choice(["-", " ", "_", "__"]).join(names) if r.random() < 0.85 else names[0] + "".join(n.capitalize() for n in names[1:])
        return f' {r.choice(["class", "class", "class", "id"])}="{value}"'

    def links(self, n: int) -> str:
        return "".join(f'<li><a href="/{self.word()}">{self.text(1, 5)}</a></li>' for _ in range(n))

    def comments(self, n: int) -> str:
        r, out = self.rng, []
        each, name = r.choice(["li", "div", "article", "p", "div"]), r.choice(["comment", "reply", "response", "message", "", ""])
        for _ in range(n):
            by = r.choice(["", f"<b>{self.word()}</b> ", f"<cite>{self.word()}</cite>", f"<h4>{self.word()} {self.word()}</h4>"])
            said = "".join(f"<p>{self.text(3, 70)}</p>" for _ in range(r.choice([1, 1, 1, 2]))) if each != "p" and r.random() < 0.7 else self.text(3, 60)
            out.append(f'<{each}{f" class={name}" if name else ""}>{by}{said}</{each}>')
        return "".join(out)

    def rest(self, kind: str | None = None) -> str:
        r = self.rng
        kind = kind or r.choice(list(_REST))
        tag = r.choice(_TAGS[kind])
        k, in_list = r.random(), tag in ("ul", "ol")
        if kind == "comments":
            inner = self.comments(r.randint(1, 6)) if not in_list else "".join(f"<li>{self.comments(1)}</li>" for _ in range(r.randint(1, 5)))
            if not in_list and r.random() < 0.5:
                inner = f"<h{r.choice('234')}>{self.text(1, 4)}</h3>" + inner
            if k < 0.2 and not in_list:  # only an invitation
                inner = f"<h3>{self.text(1, 5)}</h3><form><label>{self.word()}</label><input name=c></form>"
            elif not in_list and r.random() < 0.3:
                inner += f"<form><input name=c><button>{self.word()}</button></form>"
        elif kind == "form":
            inner = f"<label>{self.word()}</label><input name=q><p>{self.text(1, 15)}</p><button>{self.word()}</button>"
        elif kind == "menu" and not in_list and k < 0.4:
            inner = r.choice([" ", " | ", ""]).join(f"<a href=/{self.word()}>{self.text(1, 2)}</a>" for _ in range(r.randint(1, 6)))
        elif in_list or kind == "menu" or (kind in ("footer", "aside", "share", "header") and k < 0.5):
            body = self.links(r.randint(2, 9))
            inner = body if in_list else (f"<h3>{self.text(1, 3)}</h3>" if r.random() < 0.4 else "") + (f"<ul>{body}</ul>" if r.random() < 0.8 else body.replace("<li>", " ").replace("</li>", " "))
        elif kind == "header":
            inner = r.choice([f"<a href=/>{self.text(1, 3)}</a>", f"<h1>{self.text(1, 3)}</h1>", f"<h1><a href=/>{self.text(1, 2)}</a></h1>", f"<div>{self.text(1, 3)}</div>"])
            inner += r.choice(["", f"<p>{self.text(2, 9)}</p>", f"<nav>{self.links(3)}</nav>", f"<nav><a href=1>{self.word()}</a> <a href=2>{self.word()}</a></nav>"])
        elif kind == "aside" and k < 0.8:
            inner = f"<h3>{self.text(1, 4)}</h3>" + "".join(f"<p>{self.text(3, 30)}</p>" for _ in range(r.randint(1, 4)))
        else:
            inner = self.text(2, 30) if r.random() < 0.6 else f"<p>{self.text(2, 45)}</p>"
        return f"<{tag}{self.named(_REST[kind].split(), tag in _BARE)} data-mark=zzout>{inner}</{tag}>"

    def parts(self) -> list[str]:
        """Blocks of an article."""
        r = self.rng
        out = []
        if r.random() < 0.8:
            title = f"<h1>{self.text(2, 12)}</h1>"
            own = f"<header{self.named(_ARTICLE + ['header', 'header', 'title', 'head'], True)}>{title}{f'<p>{self.text(3, 12)}</p>' if r.random() < 0.5 else ''}</header>"
            out.append(title if r.random() < 0.7 else own if r.random() < 0.7 else own.replace("header", "div", 1).replace("</header>", "</div>"))
        for _ in range(r.choice([1, 2, 3, 4, 6, 9, 14])):
            k, n = r.random(), r.choice([1, 2, 4, 8, 30, 80, 150])
            if k < 0.6:
                out.append(f"<p>{self.text(1, n)}{'<a href=x>' + self.word() + '</a> ' + self.text(1, 9) if r.random() < 0.15 else ''}</p>")
            elif k < 0.68:
                out.append(f"<h{r.choice('234')}>{self.text(1, 6)}</h2>")
            elif k < 0.75:
                items = "".join(f"<li>{self.text(2, 15)}</li>" for _ in range(r.randint(2, 5)))
                out.append(r.choice([f"<ul>{items}</ul>", f"<ol>{items}</ol>"]))
            elif k < 0.79:
                out.append(f"<blockquote><p>{self.text(5, 30)}</p></blockquote>")
            elif k < 0.84:
                out.append(r.choice([f"<pre>{self.text(1, 40)}</pre>", f"<pre><code>{self.text(1, 30)}</code></pre>", f"<div class=highlight><pre>{self.text(2, 30)}</pre></div>"]))
            elif k < 0.9:
                out.append(f"<figure><img src=x>{f'<figcaption>{self.text(1, 14)}</figcaption>' if r.random() < 0.9 else ''}</figure>")
            elif k < 0.94:
                out.append("<table>" + "".join(f"<tr><td>{self.text(1, 4)}</td><td>{self.text(1, 4)}</td></tr>" for _ in range(r.randint(2, 4))) + "</table>")
            elif k < 0.96:
                out.append(f"<dl><dt>{self.text(1, 2)}</dt><dd>{self.text(2, 12)}</dd></dl>")
            elif k < 0.98:
                out.append(f"<div>{self.text(2, 60)}</div>" if r.random() < 0.5 else f"{self.text(2, 40)}<br><br>{self.text(2, 40)}")
            else:
                out.append(f"<p><b>{self.text(3, 30)}<br><p>{self.text(3, 30)}</p>")
        # names that say nothing
        return [re.sub("^<([a-z]+[0-9]?)>", lambda m: f"<{m[1]}{self.named([self.word(), self.word(), 'title', 'heading', 'headline', 'lead', 'intro', 'summary', 'first', 'caption'], False)}>", x) if r.random() < 0.12 else x for x in out]

    def page(self) -> tuple[str, bool]:
        """A page, marked by the private tokens zzin (content) and zzout (the rest) in its elements, and whether unmarked text is content."""
        r = self.rng
        kind = r.random()
        if kind < 0.04:
            return self.text(1, 200), True
        parts = self.parts()
        if kind < 0.12:  # nothing but blocks
            return ("".join(parts) if r.random() < 0.5 else f"<html><body>{''.join(parts)}</body></html>"), True
        around = lambda most: [self.rest() for _ in range(r.randint(0, most))]
        for _ in range(r.choice([0, 0, 0, 1, 1, 2])):  # the rest inside the article
            inside = self.rest(r.choice(["comments", "aside", "ad", "share", "form", "notice"]))
            parts.insert(len(parts) if r.random() < 0.5 else r.randint(0, len(parts)), inside)
        if kind < 0.25:  # blocks of the body, among other parts
            return "<html><body>" + "".join([*around(4), *parts, *around(4)]) + "</body></html>", True
        tag = r.choice(["article", "main", "div", "div", "section", "td"])
        if tag == "td":
            article = f"<table><tr><td data-mark=zzin>{''.join(parts)}</td></tr></table>"
        else:
            inner = "".join(parts)
            if r.random() < 0.25:
                inner = f"<div{self.named(_ARTICLE, True)}>{inner}</div>"
            article = f"<{tag}{self.named(_ARTICLE, tag in ('article', 'main') or r.random() < 0.3)} data-mark=zzin>{inner}</{tag}>"
        after = [self.rest("comments")] if r.random() < 0.25 else []
        body = [*around(4), article, *after, *around(4)]
        for _ in range(r.choice([0, 0, 1, 2])):
            body = [f'<div{self.named(["wrap", "container", "page", "row", "layout", "site", "wrapper", "app", "root"], True)}>', *body, "</div>"]
        return "<!DOCTYPE html><html><head></head><body>" + "".join(body) + "</body></html>", False


def _marks(source: str, page: Page, unmarked: bool) -> np.ndarray:
    """1 for elements of generated content, 0 for the rest, by the innermost mark."""
    own = [m.group(1) for m in re.finditer(r"<[a-z][^>]*?(data-mark=zz(?:in|out))?>", source)]
    assert len(own) == len(page.tag) - 1
    y = np.full(len(page.tag), float(unmarked))
    for i, mark in enumerate(own, 1):
        y[i] = y[page.parent[i]] if not mark else mark.endswith("in")
    return y


@dataclass
class Model:
    trees: boosting.Trees
    odds: np.ndarray  # log-odds of content by token
    used: np.ndarray  # flags that the trees look at

    def log_odds(self, pages: list[Page]) -> np.ndarray:
        """Of all elements of some pages, _CHUNK at a time, so that a page of any size needs little more than its own parts."""
        out, held, n = [np.zeros(0)], [], 0

        def flush() -> None:
            x, own, above = (list(v) for v in zip(*held, strict=True))
            join = lambda lists: [m for v in lists for m in v]
            out.append(self.trees.logit(np.hstack([np.vstack(x), flags(join(own), join(above), self.used)])))
            held.clear()

        for page in pages:
            x, (own, above) = np.hstack([page.numbers(), page.names(self.odds)]), page.masks()
            for i in range(0, len(x), _CHUNK):
                held.append((x[i : i + _CHUNK], own[i : i + _CHUNK], above[i : i + _CHUNK]))
                n += len(held[-1][0])
                if n >= _CHUNK:
                    flush()
                    n = 0
        if held:
            flush()
        return np.concatenate(out)


_model: list[Model] = []


def train(pages: int = TRAINING_PAGES, seed: int = SEED) -> Model:
    """Trees fitted to generated pages; the same on every call."""
    if not _model or (pages, seed) != (TRAINING_PAGES, SEED):
        rng = random.Random(seed)
        seen, counts = [], np.zeros((2, TOKENS))
        for _ in range(pages):
            source, unmarked = _Writer(rng).page()
            page = Page(source)
            set_, y, own = flags(*page.masks()), _marks(source, page, unmarked), page.lengths() > 0
            # whether an element holds both, by its text
            holds_both = np.array([len(set(y[i : page.end[i]][own[i : page.end[i]]])) > 1 for i in range(len(y))])
            pure = ~holds_both & np.array([own[i : page.end[i]].any() for i in range(len(y))])
            for i in np.flatnonzero(pure):
                for t in set(map(bucket, page.signs(i))):
                    counts[int(y[i]), t] += 1
            seen.append((page, np.nonzero(set_), y, holds_both, pure))
        share = (counts + 1) / (counts.sum(axis=1, keepdims=True) + TOKENS)
        odds = np.where(counts.sum(axis=0) >= LEAST, np.log(share[1] / share[0]), 0.0).astype(np.float32)
        xs, ys, rows, numbers, n = [], [], [], [], 0
        for page, (row, number), y, holds_both, pure in seen:
            x = np.hstack([page.numbers(), page.names(odds)])
            # elements that hold both count for either class, so that their log-odds are about 0 and decoding splits them
            for kind, label in ((pure, y), (holds_both, np.ones(len(y))), (holds_both, np.zeros(len(y)))):
                xs.append(x[kind])
                ys.append(label[kind])
                at = np.cumsum(kind) - 1 + n
                rows.append(at[row[kind[row]]])
                numbers.append(number[kind[row]])
                n += kind.sum()
        trees = boosting.fit(np.vstack(xs), (np.concatenate(rows), np.concatenate(numbers)), np.concatenate(ys), ROUNDS, DEPTH)
        found = Model(trees, odds, trees.keep(NUMERIC + NAMES) - NUMERIC - NAMES)
        if (pages, seed) != (TRAINING_PAGES, SEED):
            return found
        _model.append(found)
    return _model[0]


def decode(page: Page, logit: np.ndarray) -> np.ndarray:
    """Which elements' own text is main content: the best consistent cut of the tree. Inline elements without a name go with the element around them."""
    n, units = len(logit), page.units()
    own = np.bincount(units, weights=page.lengths(), minlength=n)
    z = np.clip(logit, -_CLIP, _CLIP)
    subtree = own.copy()
    split = own * np.abs(z)  # own text decided alone
    verdict = np.zeros(n, np.int8)  # 1 take, -1 drop, 0 split
    for i in range(n - 1, -1, -1):
        if units[i] != i:
            # what is below an inline element hangs on the unit around it
            if subtree[i]:
                subtree[units[i]] += subtree[i]
                split[units[i]] += split[i]
            continue
        whole = z[i] * subtree[i]
        scores = (whole, -whole, split[i] - _SPLIT)
        k = int(np.argmax(scores))
        verdict[i] = (1, -1, 0)[k]
        if i:
            p = page.parent[i]
            subtree[p] += subtree[i]
            split[p] += scores[k]
    chosen = np.zeros(n, bool)
    settled = np.zeros(n, np.int8)
    for i in range(n):
        if units[i] != i:
            settled[i], chosen[i] = settled[units[i]], chosen[units[i]]
            continue
        over = settled[page.parent[i]] if i else 0
        settled[i] = over or verdict[i]
        chosen[i] = settled[i] > 0 or (settled[i] == 0 and z[i] > 0)
    return chosen


def main_texts_of(sources: list[str], model: Model) -> list[str]:
    """Main texts of some pages; their elements are scored together."""
    pages = [Page(s) for s in sources]
    if not pages:
        return []
    logit = model.log_odds(pages)
    out, at = [], 0
    for p in pages:
        z, at = logit[at : at + len(p.tag)], at + len(p.tag)
        out.append("\n".join(p.blocks(decode(p, z))) if p.text else "")
    return out


def extract(pages: DataFrame, keep: list[str] | None = None, column: str = "html") -> DataFrame:
    """``pages`` with text (main text, empty if none) and n_chars (its code points)."""
    ship = pages.sparkSession.sparkContext.broadcast(train())  # fixed size

    def run(b):
        texts, some, size = [], [], 0
        for source in b[column].to_pylist():
            some.append(source or "")
            size += len(some[-1])
            if size > 400_000:
                texts += main_texts_of(some, ship.value)
                some, size = [], 0
        texts += main_texts_of(some, ship.value)
        return {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}

    return annotate(pages, run, "text string, n_chars long", keep, rows=500, reads=column)


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    return extract(pages, ["page_id", "url"]).select("page_id", "url", "text", "n_chars")
