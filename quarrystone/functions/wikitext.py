"""Wikitext to text: templates, parser functions, magic words, links, tables and tags.

The grammar nests, so that it is interpreted in Python, by Arrow batches, with the templates (a site has some
thousands, and their size is checked) broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import LEFTOVER_TAGS, NAV_LENGTH, NAV_RUN, template_name, transclusion_body

DEPTH = 20
MAX_TEMPLATE_BYTES = 256 << 20
_FUNCTION = re.compile(r"\{\{\s*#(if|ifeq|switch|ifexist)\s*:", re.I)
_PARAM = re.compile(r"\{\{\{([^{}]*)\}\}\}")
_LEFTOVER = re.compile(rf"</?(?:{LEFTOVER_TAGS.replace(' ', '|')})(?:\s[^<>]{{0,120}})?/?>", re.I)
_PAIR = re.compile(r"\{\{|\}\}|\[\[|\]\]|\|")


def closing(text: str, at: int) -> int:
    """Where the }} that closes an opened {{ begins, looking from `at`; -1 if none does."""
    depth = 1
    for m in re.compile(r"\{\{|\}\}").finditer(text, at):
        depth += 1 if m[0] == "{{" else -1
        if not depth:
            return m.start()
    return -1


def split_arguments(inner: str) -> list[str]:
    """At the bars outside of braces and links."""
    out, depth, start = [], 0, 0
    for m in _PAIR.finditer(inner):
        if m[0] == "|":
            if not depth:
                out.append(inner[start : m.start()])
                start = m.end()
        else:
            depth += 1 if m[0] in ("{{", "[[") else -1
    return [*out, inner[start:]]


def parameters(body: str, given: dict[str, str]) -> str:
    """{{{name|default}}} by the call's arguments, until nothing changes (a default or argument may hold another one)."""

    def value(m: re.Match) -> str:
        name, _, default = m[1].partition("|")
        return given.get(name.strip(), default)

    for _ in range(100):
        new = _PARAM.sub(value, body)
        if new == body:
            break
        body = new
    return body


def _chosen(function: str, args: list[str], known: frozenset[str] | set[str]) -> str:
    at = lambda k: args[k] if k < len(args) else ""
    if function == "if":
        return at(1) if at(0).strip() else at(2)
    if function == "ifeq":
        return at(2) if at(0).strip() == at(1).strip() else at(3)
    if function == "ifexist":
        return at(1) if at(0).strip() in known else at(2)
    default = ""
    for case in args[1:]:
        key, eq, value = case.partition("=")
        if not eq:
            default = case
        elif key.strip() == at(0).strip() and key.strip() != "#default":
            return value
        elif key.strip() == "#default":
            default = value
    return default


def parser_functions(text: str, known: frozenset[str] | set[str] = frozenset()) -> str:
    """#if, #ifeq, #switch and #ifexist, the leftmost first; an unclosed one ends it, others stay."""
    while m := _FUNCTION.search(text):
        end = closing(text, m.end())
        if end < 0:
            break
        text = text[: m.start()] + _chosen(m[1].lower(), split_arguments(text[m.end() : end]), known) + text[end + 2 :]
    return text


def magic_words(text: str, title: str) -> str:
    if "{{" not in text:
        return text
    base, _, sub = title.rpartition("/")
    flat = title.replace(" ", "_")
    words = {"PAGENAME": title, "FULLPAGENAME": title, "BASEPAGENAME": base or title, "SUBPAGENAME": sub, "PAGENAMEE": flat, "FULLPAGENAMEE": flat, "NAMESPACE": "", "SUBJECTSPACE": "", "TALKSPACE": "Talk"}
    return re.sub(r"\{\{\s*(" + "|".join(words) + r")\s*\}\}", lambda m: words[m[1]], text)


def normal_name(name: str) -> str:
    name = name.strip().replace("_", " ")
    return name[:1].upper() + name[1:]


def expand(text: str, templates: dict[str, str], title: str = "", known: frozenset[str] | set[str] = frozenset(), depth: int = 0) -> str:
    """Text with its template calls replaced by the templates' bodies, and those of these, DEPTH deep at most; unknown templates stay."""
    if depth >= DEPTH:
        return text
    text = magic_words(parser_functions(text, known), title)
    out, at, changed = [], 0, False
    while (start := text.find("{{", at)) >= 0:
        if text.startswith("{{{", start) and not text.startswith("{{{{", start):
            out.append(text[at : start + 3])
            at = start + 3
            continue
        end = closing(text, start + 2)
        if end < 0:
            break
        name, *args = split_arguments(text[start + 2 : end])
        body = templates.get(normal_name(name))
        out.append(text[at:start])
        if body is None:
            out.append(text[start : end + 2])
        else:
            given = {}
            for k, arg in enumerate(args, 1):
                key, eq, value = arg.partition("=")
                given[key.strip() if eq else str(k)] = value if eq else arg
            out.append(parameters(body, given))
            changed = True
        at = end + 2
    out.append(text[at:])
    return expand("".join(out), templates, title, known, depth + 1) if changed else "".join(out)


_COMMENT = re.compile(r"<!--.*?-->", re.S)
_DROPPED = re.compile(r"<(ref|gallery|math|score|timeline)\b[^<>]*?(?:/>|>.*?</\1\s*>)", re.S | re.I)
_TABLE = re.compile(r"^\s*(?:\{\|.*|\|\}|\|-.*|[!|](?:[^|\n\[\]]*=[^|\n]*\|(?!\|))?)", re.M)
_HEADING = re.compile(r"^(={1,6})\s*(.*?)\s*\1\s*$", re.M)
_EXTERNAL = re.compile(r"\[(?:https?|ftp)://\S+?(?:\s+([^\]]*))?\]")
_QUOTES = re.compile(r"'{2,5}")
_LIST = re.compile(r"^[*#:;]+\s*", re.M)
_PAIRED = re.compile(r"<(\w+)(?:\s[^<>]*)?>(.*?)</\1\s*>", re.S)


def _links(text: str, category: str) -> str:
    """[[Target|label]] to the label or target, the innermost first; category links go."""
    inner = re.compile(r"\[\[([^\[\]]*)\]\]")

    def shown(m: re.Match) -> str:
        target, bar, label = m[1].partition("|")
        name = target.strip()
        if name.startswith((category + ":", category.lower() + ":")):
            return ""
        return label.rpartition("|")[2] if bar else target

    while (new := inner.sub(shown, text)) != text:
        text = new
    return text


def without_nav_lines(text: str, run: int = NAV_RUN) -> str:
    """The same as functions.text.strip_nav_lines, on a string."""
    lines, out, at = text.split("\n"), [], 0
    nav = [0 < len(x.strip()) < NAV_LENGTH and not any(c in x for c in "।॥.!?") for x in lines]
    while at < len(lines):
        end, last, n = at, at, 0
        while nav[at] and end < len(lines) and (nav[end] or not lines[end].strip()):
            n += nav[end]
            end += 1
            if nav[end - 1]:
                last = end
        if n:
            out += [] if n >= run else lines[at:last]
            at = last
        else:
            out.append(lines[at])
            at += 1
    return "\n".join(out)


def strip(text: str, category: str = "Category") -> str:
    """Text of expanded wikitext, without markup, category links, leftover tags and navigation lists."""
    text = _DROPPED.sub("", _COMMENT.sub("", text))
    text = _links(text, category)
    text = _EXTERNAL.sub(lambda m: m[1] or "", text)
    text = _HEADING.sub(r"\2", text)
    text = _TABLE.sub("", text)
    text = _LIST.sub("", _QUOTES.sub("", text))
    while (new := _PAIRED.sub(r"\2", text)) != text:
        text = new
    while "{{" in text:  # calls that nothing expanded
        start = text.rfind("{{")
        end = text.find("}}", start)
        if end < 0:
            break
        text = text[:start] + text[end + 2 :]
    return without_nav_lines(_LEFTOVER.sub("", text))


def template_index(pages: DataFrame, namespace: str) -> dict[str, str]:
    """Bodies by name of template pages (title, text). Refuses more than MAX_TEMPLATE_BYTES, which a driver should not hold."""
    rows = pages.where(F.col("title").startswith(namespace + ":")).select(template_name(F.substr("title", F.lit(len(namespace) + 2))).alias("name"), transclusion_body(F.col("text")).alias("body"))
    size = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    if size > MAX_TEMPLATE_BYTES:
        raise ValueError(f"{size} bytes of templates")
    return {r["name"]: r["body"] for r in rows.toLocalIterator()}


def with_text(pages: DataFrame, templates: dict[str, str], known: set[str] = frozenset(), category: str = "Category", text: str = "text", title: str = "title", transliterated: bool = False) -> DataFrame:
    """Pages with `stripped`, `raw_bytes`, `content_bytes` and, if asked for, `transliterated_bytes`."""
    from .translit import transliterate

    if sum(map(len, known)) > MAX_TEMPLATE_BYTES:
        raise ValueError("more titles than a broadcast should hold")
    shared = pages.sparkSession.sparkContext.broadcast((templates, frozenset(known)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bodies, there = shared.value
        for b in batches:
            names = b.schema.names
            out = [strip(expand(t or "", bodies, n or "", there), category) for t, n in zip(b.column(names.index(text)).to_pylist(), b.column(names.index(title)).to_pylist(), strict=True)]
            more = [pa.array([len(transliterate(x).encode()) if x.strip() else 0 for x in out], pa.int64())] if transliterated else []
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string()), *more], names=[*names, "stripped"] + ["transliterated_bytes"] * transliterated)

    from pyspark.sql.types import LongType, StringType, StructField, StructType

    schema = StructType([*pages.schema.fields, StructField("stripped", StringType()), *[StructField("transliterated_bytes", LongType())] * transliterated])
    return pages.mapInArrow(run, schema).withColumns({"raw_bytes": F.octet_length(text).cast("bigint"), "content_bytes": F.octet_length("stripped").cast("bigint")})
