"""Main text of HTML pages by gradient-boosted trees over DOM nodes and a hierarchical decoding.

A page becomes a tree of block elements and text blocks (inline elements are part of their block).
Each node has features of its subtree (text, links, tags and punctuation, their densities), of its
attributes' tokens and its ancestors' ones, of its depth, and of its siblings. Boosted trees, trained
here on pages that a seeded generator lays out in many ways, give each node the log odds of being main
text. Decoding keeps the set of nodes with the largest sum in which no kept node has a dropped
ancestor, by one pass up the tree and one down.

Blocks' text: character references decoded, white space (a <br> too) made one space, trimmed; blocks in
page order joined by line feeds. Defined results: null html counts as empty and gives empty text; pages
without tags are one block; broken markup is read as browsers do in the main cases (unclosed p, li and
inline elements, comments, raw text elements), and never fails; repeated rows are extracted each; other
columns are left out. Nothing is cut off: long pages are taken whole.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import Boosted, boost
from .shared import sent

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_QUOTED = re.compile(r"""(?:[^>"']++|"[^"]*"|'[^']*')*+>""")
_ATTR = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")

BLOCKS = frozenset(
    "html body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption section article main header footer nav aside form fieldset blockquote pre figure figcaption address hr details summary dialog center menu".split()
)
#: What has no text of the page, whatever is around it.
SILENT = frozenset("script style noscript template iframe textarea title select svg canvas object video audio button math applet".split())
#: An open element of the first kind ends where one of the second begins.
ENDS = {"p": BLOCKS - {"html", "body"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "h1": set(), "option": {"option"}}
#: Beyond these an implied end does not reach.
WALLS = frozenset("ul ol dl table article section div main aside nav header footer form blockquote body html td th".split())

#: Elements nested deeper are not nodes of their own, as in browsers; their text is their ancestor's.
DEPTH = 512
_SILENT_END = {name: re.compile(f"</{name}\\b[^>]*>?", re.I) for name in SILENT}
#: The elements that the start of each ends.
_ENDED = {name: [own for own, by in ENDS.items() if name in by] for name in BLOCKS | {"option"}}

_GROUPS = (
    ("nav", "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs toolbar skip"),
    ("side", "sidebar aside widget rail related recommended trending popular tags tagcloud archive"),
    ("ad", "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner adslot dfp outbrain taboola"),
    ("notice", "cookie cookies consent gdpr notice alert message popup modal overlay paywall disclaimer legal warning announcement"),
    ("comment", "comment comments reply replies respond discussion disqus thread feedback review reviews"),
    ("foot", "footer foot bottom copyright colophon"),
    ("head", "header head masthead topbar top logo branding site"),
    ("form", "form login signin signup subscribe newsletter search register contact"),
    ("share", "share sharing social follow twitter facebook byline author meta date"),
    ("main", "main content article post entry story text body page blog news hentry single prose"),
)
TOKENS = {w: k for k, (_, words) in enumerate(_GROUPS) for w in words.split()}
#: Words that others begin with: commentlist, sidebarleft.
_STEMS = sorted((w for w in TOKENS if len(w) >= 6), key=len, reverse=True)
_TAGS = ("p", "div", "article", "main", "section", "nav", "header", "footer", "aside", "form", "ul", "li", "table", "td", "blockquote", "heading", "figure", "pre", "body", "#text")
_TAG_AT = {t: k for k, t in enumerate(_TAGS)} | {f"h{k}": _TAGS.index("heading") for k in range(1, 7)} | {"ol": _TAGS.index("ul"), "dl": _TAGS.index("ul"), "dd": _TAGS.index("li"), "dt": _TAGS.index("li"), "th": _TAGS.index("td"), "figcaption": _TAGS.index("figure"), "html": _TAGS.index("body")}


class Page:
    """Nodes in page order: tags, parents, tokens of attributes, and texts of the text blocks."""

    __slots__ = ("links", "parent", "tag", "text", "tokens", "inner")

    def __init__(self, source: str):
        self.tag, self.parent, self.tokens, self.text, self.links, self.inner = ["body"], [-1], [0], [None], [0], [0]
        self._read(source)

    def _add(self, tag: str, parent: int, tokens: int, text: str | None = None, links: int = 0) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.tokens.append(tokens)
        self.text.append(text)
        self.links.append(links)
        self.inner.append(0)
        return len(self.tag) - 1

    def _read(self, source: str) -> None:
        """One pass. What has been sought in vain is not sought again, and the stack has DEPTH elements at most, so that no markup takes more than linear time."""
        stack, parts, linked, in_link, at = [0], [], 0, 0, 0
        end_of, quoted, endless = len(source), True, set()
        open_: dict[str, int] = {}

        def flush() -> None:
            nonlocal parts, linked
            if parts:
                text = " ".join("".join(parts).split())
                if text:
                    self._add("#text", stack[-1], 0, text, min(linked, len(text)))
                parts, linked = [], 0

        def add(raw: str) -> None:
            nonlocal linked
            if raw:
                text = html.unescape(raw) if "&" in raw else raw
                parts.append(text)
                if in_link:
                    linked += len(text)

        def close(k: int) -> None:
            for node in stack[k:]:
                open_[self.tag[node]] -= 1
            del stack[k:]

        held = 0  # where the text that is not added yet begins
        while at < end_of:
            begin = source.find("<", at)
            if begin < 0:
                break
            mark = source[begin + 1 : begin + 2]
            if mark in ("!", "?"):
                add(source[held:begin])
                end = source.find("-->", begin + 4) + 2 if source.startswith("<!--", begin) else source.find(">", begin + 2)
                at = held = end + 1 if end > begin else end_of
                continue
            m = _NAME.match(source, begin)
            if not m:
                at = begin + 1
                continue
            end = -1
            if quoted:
                q = _QUOTED.match(source, m.end())
                # after a tag whose quotes don't end, quotes don't count
                quoted, end = q is not None, q.end() - 1 if q else -1
            if end < 0:
                end = source.find(">", m.end())
                if end < 0:
                    break
            add(source[held:begin])
            at = held = end + 1
            closing, name, attributes = m[1], m[2].lower(), source[m.end() : end]
            if name in SILENT:
                if not closing and not attributes.endswith("/"):
                    over = None if name in endless else _SILENT_END[name].search(source, at)
                    if over:
                        at = held = over.end()
                    elif name in ("script", "style"):
                        held = end_of
                        break
                    else:
                        endless.add(name)
                parts.append(" ")
            elif name in BLOCKS:
                flush()
                if name in ("html", "body"):
                    if not closing:
                        self.tokens[0] |= _tokens(attributes)
                elif closing:
                    if open_.get(name):
                        close(next(k for k in range(len(stack) - 1, 0, -1) if self.tag[stack[k]] == name))
                else:
                    if any(open_.get(x) for x in _ENDED[name]):
                        for k in range(len(stack) - 1, 0, -1):
                            own = self.tag[stack[k]]
                            if name in ENDS.get(own, ()):
                                close(k)
                                if name not in ("tr", "tbody", "tfoot"):
                                    break
                            elif own in WALLS and not (own in ("td", "th") and name in ENDS[own]):
                                break
                    if len(stack) < DEPTH:
                        node = self._add(name, stack[-1], _tokens(attributes))
                        if name != "hr":
                            stack.append(node)
                            open_[name] = open_.get(name, 0) + 1
                in_link = 0
            elif name == "a":
                in_link = 0 if closing else 1
                self.inner[stack[-1]] += 1
            elif name == "br":
                parts.append(" ")
            else:
                self.inner[stack[-1]] += 1
        add(source[held:end_of])
        flush()


@lru_cache(4096)
def _tokens(attributes: str) -> int:
    """Which groups of tokens the class, id and role have, as bits."""
    out = 0
    for m in _ATTR.finditer(attributes):
        value = re.sub(r"([a-z])([A-Z])", r"\1 \2", m[2] or m[3] or m[4] or "")
        for w in _WORD.findall(value.lower()):
            if (k := TOKENS.get(w)) is None:
                k = next((TOKENS[stem] for stem in _STEMS if w.startswith(stem)), None)
            if k is not None:
                out |= 1 << k
    return out


_MARKS = re.compile(r"[.!?。।]")
N_FEATURES = 14 + len(_TAGS) * 2 + len(_GROUPS) * 2


def features(page: Page) -> np.ndarray:
    """One row for each node."""
    n = len(page.tag)
    parent = np.array(page.parent)
    size, links, marks, words, tags, blocks = (np.zeros(n) for _ in range(6))
    for k, t in enumerate(page.text):
        if t is not None:
            size[k], links[k], marks[k], words[k], blocks[k] = len(t), page.links[k], len(_MARKS.findall(t)), t.count(" ") + 1, 1
    tags += np.array(page.inner) + 1
    kids, order, depth = np.zeros(n), np.zeros(n), np.zeros(n)
    above = [0] * n
    kind = [_TAG_AT.get(t, 1) for t in page.tag]
    kinds_above = [0] * n
    seen: dict[int, int] = {}
    for k in range(1, n):
        p = page.parent[k]
        depth[k] = depth[p] + 1
        above[k] = above[p] | page.tokens[p]
        kinds_above[k] = kinds_above[p] | (1 << kind[p])
        order[k] = seen.get(p, 0)
        seen[p] = seen.get(p, 0) + 1
        kids[p] += 1
    sums = np.stack((size, links, marks, words, tags, blocks), 1)
    rows = sums.tolist()
    for k in range(n - 1, 0, -1):  # a parent comes before its children
        a, b = rows[page.parent[k]], rows[k]
        for c in range(6):
            a[c] += b[c]
    size, links, marks, words, tags, blocks = np.array(rows).T
    up = np.maximum(parent, 0)
    out = np.zeros((n, N_FEATURES), np.float32)
    out[:, 0] = np.log1p(size)
    out[:, 1] = links / np.maximum(size, 1)
    out[:, 2] = tags / (1 + words)
    out[:, 3] = marks / (1 + words)
    out[:, 4] = words / np.maximum(blocks, 1)
    out[:, 5] = depth
    out[:, 6] = size / np.maximum(size[up], 1)
    out[:, 7] = size / max(size[0], 1)
    out[:, 8] = order / np.maximum(kids[up], 1)
    out[:, 9] = kids[up]
    out[:, 10] = kids
    out[:, 11] = np.log1p(size[up])
    out[:, 12] = links[up] / np.maximum(size[up], 1)
    out[:, 13] = np.log1p(marks)
    own = np.array(kind)
    at = 14
    out[np.arange(n), at + own] = 1
    out[np.arange(n), at + own[up]] += 0.5
    at += len(_TAGS)
    bits = np.array(kinds_above)
    for k in range(len(_TAGS)):
        out[:, at + k] = (bits >> k) & 1
    at += len(_TAGS)
    mine, over = np.array(page.tokens), np.array(above)
    for k in range(len(_GROUPS)):
        out[:, at + k] = (mine >> k) & 1
        out[:, at + len(_GROUPS) + k] = (over >> k) & 1
    return out


def decode(page: Page, odds: np.ndarray) -> list[bool]:
    """The nodes to keep: those of the largest sum of weighed log odds in which every kept node's parent is kept."""
    n = len(page.tag)
    gain = [(0.3 if t is None else 1 + np.log1p(len(t))) * float(o) for t, o in zip(page.text, odds, strict=True)]
    gain[0] = 0.0
    for k in range(n - 1, 0, -1):
        if gain[k] > 0:
            gain[page.parent[k]] += gain[k]
    keep = [False] * n
    keep[0] = True
    for k in range(1, n):
        keep[k] = keep[page.parent[k]] and gain[k] > 0
    return keep


def text_of(page: Page, keep: list[bool]) -> str:
    return "\n".join(t for t, k in zip(page.text, keep, strict=True) if k and t is not None)


def main_text(sources: list[str], model: Boosted) -> list[str]:
    pages = [Page(s) for s in sources]
    if not pages:
        return []
    odds = model.decision(np.concatenate([features(p) for p in pages]))
    out, at = [], 0
    for p in pages:
        out.append(text_of(p, decode(p, odds[at : at + len(p.tag)])))
        at += len(p.tag)
    return out


@lru_cache(1)
def trained(pages: int = 500, seed: int = 11) -> Boosted:
    """The model, from generated pages."""
    from .html_pages import generate

    x, y, w = [], [], []
    for source, marker in generate(pages, seed):
        page = Page(source)
        total = np.array([0 if t is None else len(t) for t in page.text], float)
        main = np.array([0 if t is None or marker not in t else len(t) for t in page.text], float)
        page.text = [None if t is None else t.replace(marker, "") for t in page.text]
        for k in range(len(total) - 1, 0, -1):
            total[page.parent[k]] += total[k]
            main[page.parent[k]] += main[k]
        f = features(page)
        some = total > 0
        some[0] = False
        x.append(f[some])
        y.append(main[some] > 0.5 * total[some])
        w.append(np.full(some.sum(), 1 / np.sqrt(max(some.sum(), 1))))
    return boost(np.concatenate(x), np.concatenate(y).astype(float), np.concatenate(w))


def extract(pages: DataFrame, model: Boosted | None = None, id_col: str = "page_id", html_col: str = "html", carry: tuple[str, ...] = ("url",)) -> DataFrame:
    """Per page: its id, the columns of `carry`, `text` and `n_chars`."""
    shared = sent(pages.sparkSession, model or trained())
    fields = {f.name: f.dataType.simpleString() for f in pages.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                part = b.slice(lo, 64)
                texts = main_text([s or "" for s in part.column(part.num_columns - 1).to_pylist()], shared.value)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[f"c{k}" for k in range(len(carry) + 1)] + ["text", "n_chars"])

    names = [id_col, *carry]
    schema = ", ".join(f"c{k} {fields[c]}" for k, c in enumerate(names)) + ", text string, n_chars bigint"
    out = pages.select(*[F.col(c).alias(f"c{k}") for k, c in enumerate(names)], F.col(html_col).cast("string").alias("__html")).mapInArrow(run, schema)
    return out.toDF(*names, "text", "n_chars")
