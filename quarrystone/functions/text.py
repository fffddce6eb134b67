"""Column expressions on titles, wikitext, URLs, sizes and dates. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Titles of maintenance categories, and words that mark others, in the corpus that the library was made for.
EXCLUDED_TITLES = (
    "अवैध एचटीएमएल टैग का उपयोग कर रहे पृष्ठ",
    "अनिर्दिष्टानि पुटानि",
    "निष्कासनाय",
    "वर्गनिर्वहणम्",
    "विकिस्रोतः",
    "Formatting templates",
    "Index Validated",
    "Works",
    "Works by year",
    "टेम्पलेट लूप वाले पेज",
    "अनुक्रमणिका - Unknown progress",
    "Candidates for speedy deletion",
    "Delete",
    "PD-old",
    "अनुक्रमणिका फलकानि",
    "असूचकांकितानि पृष्ठानि",
    "निर्वाचितलेखाः",
    "विकिपीडियालेखः",
)
EXCLUDED_MARKS = ("विकिस्रोत", "ग्रन्थकर्तारः", "अनुसरणवर्गाः", "पाठशुद्धिस्पर्धा")

DEVANAGARI_DIGITS, ASCII_DIGITS = "०१२३४५६७८९", "0123456789"

#: Patterns of the markup (Java's; (?U) where white space and digits are Unicode's). {} stands for a quoted name.
CATEGORY_LINK = r"(?U)\[\[\s*{}\s*:\s*([^\]\|]+?)\s*(?:\|[^\]]*)?\]\]"
PAGES_TAG = r"(?iU)<pages[.\s][^>]*>"
PAGES_INDEX_FIRST = r"(?iU)<pages[.\s]index\s*=\s*(?:\"([^\"]*)\"|([^\s/>]+))"
TAG_ATTRIBUTE = r"(?iU)\b{}\s*=\s*(?:\"([^\"]*)\"|([^\s/>]+))"
ONLYINCLUDE = r"(?is)<onlyinclude\s*>(.*?)</onlyinclude>"
NOINCLUDE = r"(?is)<noinclude\s*/?>.*?</noinclude>|<noinclude\s*/>"
INCLUDEONLY_TAGS = r"(?i)</?includeonly\s*/?>"
REDIRECT = r"^\s*#\s*\S[^\[\]\n]{0,60}?\[\[([^\]|\n]+)"
URL = r"https?://[^\s\]\|\}\)]+"

#: HTML tags that malformed wikitext leaves behind.
LEFTOVER_TAGS = "table tr td th tbody thead tfoot caption b i u s em strong br hr p div span center small big sub sup font blockquote poem"


def quoted(text: str) -> str:
    """Text as a literal in a Java pattern."""
    return "".join("\\" + c if c in r"\.[]{}()*+?^$|#&-~" else c for c in text)


def utrim(x: Column) -> Column:
    """Without white space at the ends, by Unicode."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def lower_ascii(x: Column) -> Column:
    return F.translate(x, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- links and categories


def category_links(text: Column, namespace: str) -> Column:
    """Titles in [[namespace:Title|sort key]], in order, trimmed."""
    return F.transform(F.regexp_extract_all(text, F.lit(CATEGORY_LINK.replace("{}", quoted(namespace))), F.lit(1)), utrim)


def direct_categories(text: Column, namespace: str) -> Column:
    return F.array_distinct(category_links(text, namespace))


def bare_title(title: Column) -> Column:
    """Without the prefix up to the first colon."""
    return utrim(F.regexp_replace(title, r"^[^:]*:", ""))


def is_excluded(title: Column, titles: tuple[str, ...] = EXCLUDED_TITLES, marks: tuple[str, ...] = EXCLUDED_MARKS) -> Column:
    """Whether a category is one of `titles` or has one of `marks` anywhere, its prefix aside."""
    bare = bare_title(title)
    out = bare.isin(list(titles)) if titles else F.lit(False)
    for mark in marks:
        out = out | bare.contains(mark)
    return out


def owning_index(leaf_title: Column) -> Column:
    """prefix:Index/12 to Index: the text before the last slash; null without one."""
    return F.nullif(F.regexp_extract(F.regexp_replace(leaf_title, r"^[^:]*:", ""), r"(?s)^(.*)/[^/]*$", 1), F.lit(""))


# -- digits and numbers


def ascii_digits(x: Column) -> Column:
    return F.translate(x, DEVANAGARI_DIGITS, ASCII_DIGITS)


def devanagari_digits(x: Column) -> Column:
    return F.translate(x, ASCII_DIGITS, DEVANAGARI_DIGITS)


def parse_int(x: Column) -> Column:
    """A whole number in ASCII or Devanagari digits, or null."""
    return utrim(ascii_digits(x)).try_cast("int")


def leaf_number(title: Column) -> Column:
    """The number after the last slash, or null."""
    tail = ascii_digits(F.regexp_extract(title, r"(?s)/([^/]*)$", 1))
    return F.when(tail.rlike(r"^[0-9]+$"), tail).try_cast("int")


# -- <pages> tags


def _attribute(tag: Column, name: str) -> Column:
    pattern = TAG_ATTRIBUTE.replace("{}", name)
    return F.nullif(F.coalesce(F.nullif(F.regexp_extract(tag, pattern, 1), F.lit("")), F.regexp_extract(tag, pattern, 2)), F.lit(""))


#: No scan has a leaf of a higher number; a range that goes on ends there, so that a mistyped one makes no endless list.
LARGEST_LEAF = 100_000


def include_numbers(x: Column) -> Column:
    """1,3,5-8 to the distinct numbers; fragments that are no number or range are skipped; null stays null."""

    def part(p: Column) -> Column:
        lo, hi = parse_int(F.regexp_extract(p, r"^([^-]*)-", 1)), parse_int(F.regexp_extract(p, r"^[^-]*-(.*)$", 1))
        single = parse_int(p)
        none = F.expr("cast(array() as array<int>)")
        # a range that runs backward is empty
        ranged = F.when(lo.isNotNull() & hi.isNotNull() & (lo <= hi), F.sequence(lo, F.greatest(lo, F.least(hi, F.lit(LARGEST_LEAF))))).otherwise(none)
        return F.when(p.contains("-"), ranged).otherwise(F.when(single.isNotNull(), F.array(single)).otherwise(none))

    return F.array_distinct(F.flatten(F.transform(F.split(x, ","), part)))


def transclusion_ranges(text: Column) -> Column:
    """Of each <pages> tag with an index: index_title, from_n, to_n, include."""
    tags = F.regexp_extract_all(text, F.lit(PAGES_TAG), F.lit(0))
    made = F.transform(
        tags,
        lambda t: F.struct(
            utrim(_attribute(t, "index")).alias("index_title"), parse_int(_attribute(t, "from")).alias("from_n"), parse_int(_attribute(t, "to")).alias("to_n"), include_numbers(_attribute(t, "include")).alias("include")
        ),
    )
    return F.filter(made, lambda r: r["index_title"].isNotNull() & (r["index_title"] != ""))


def first_attribute_indexes(text: Column) -> Column:
    """Indexes of <pages> tags whose first attribute is the index."""
    tags = F.regexp_extract_all(text, F.lit(PAGES_INDEX_FIRST), F.lit(0))
    both = F.transform(tags, lambda t: utrim(F.coalesce(F.nullif(F.regexp_extract(t, PAGES_INDEX_FIRST, 1), F.lit("")), F.regexp_extract(t, PAGES_INDEX_FIRST, 2))))
    return F.array_distinct(F.filter(both, lambda t: t != ""))


# -- templates and markup


def transclusion_body(text: Column) -> Column:
    """What a template's page gives where it is used: only onlyinclude parts if any, else without noinclude parts and includeonly tags."""
    only = F.regexp_extract_all(text, F.lit(ONLYINCLUDE), F.lit(1))
    rest = F.regexp_replace(F.regexp_replace(text, NOINCLUDE, ""), INCLUDEONLY_TAGS, "")
    return F.when(F.size(only) > 0, F.array_join(only, "")).otherwise(rest)


def template_name(name: Column) -> Column:
    name = F.replace(utrim(name), F.lit("_"), F.lit(" "))
    return F.concat(F.upper(F.substr(name, F.lit(1), F.lit(1))), F.substr(name, F.lit(2)))


def strip_leftover_tags(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?i)</?(?:{LEFTOVER_TAGS.replace(' ', '|')})(?:\s[^<>]{{0,120}})?/?>", "")


def redirect_target(text: Column) -> Column:
    """Target of a redirecting wikitext, or null."""
    return F.nullif(utrim(F.regexp_extract(text, REDIRECT, 1)), F.lit(""))


NAV_LENGTH, NAV_RUN = 40, 5


def is_nav_line(line: Column) -> Column:
    """A short line without the marks that end sentences."""
    n = F.length(utrim(line))
    return (n > 0) & (n < NAV_LENGTH) & ~line.rlike(r"[।॥.!?]")


def strip_nav_lines(text: Column, run: int = NAV_RUN) -> Column:
    """Without runs of at least `run` navigation lines. Blank lines neither break a run nor count; those at its end stay.

    One pass over the lines with the open run held aside: it is dropped or given back when a line of text ends it.
    """
    state = F.struct(F.expr("cast(array() as array<string>)").alias("out"), F.expr("cast(array() as array<string>)").alias("run"), F.lit(0).alias("n"), F.expr("cast(array() as array<string>)").alias("blank"))
    empty = F.expr("cast(array() as array<string>)")

    def closed(s: Column) -> Column:
        return F.concat(s["out"], F.when(s["n"] >= run, empty).otherwise(s["run"]), s["blank"])

    def step(s: Column, line: Column) -> Column:
        nav, blank = is_nav_line(line), utrim(line) == ""
        inside = s["n"] > 0
        extended = F.struct(s["out"].alias("out"), F.concat(s["run"], s["blank"], F.array(line)).alias("run"), (s["n"] + 1).alias("n"), empty.alias("blank"))
        waiting = F.struct(s["out"].alias("out"), s["run"].alias("run"), s["n"].alias("n"), F.concat(s["blank"], F.array(line)).alias("blank"))
        plain = F.struct(F.concat(closed(s), F.array(line)).alias("out"), empty.alias("run"), F.lit(0).alias("n"), empty.alias("blank"))
        return F.when(nav, extended).when(blank & inside, waiting).otherwise(plain)

    return F.array_join(F.aggregate(F.split(text, "\n"), state, step, closed), "\n")


# -- URLs


def page_url(base: str, title: Column) -> Column:
    """base and the title with _ for spaces, percent-encoded; / and ~ stay, * does not."""
    done = F.url_encode(F.replace(title, F.lit(" "), F.lit("_")))
    for a, b in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        done = F.replace(done, F.lit(a), F.lit(b))
    return F.concat(F.lit(base), done)


def urls_in(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(URL), F.lit(0))


def url_host(url: Column) -> Column:
    """Network location in lower case, without www. and without marks that end a sentence."""
    host = F.lower(F.regexp_extract(F.regexp_replace(url, r"[\].,]+$", ""), r"^[A-Za-z]+://([^/?#]*)", 1))
    return F.regexp_replace(host, r"^www\.", "")


# -- sizes, counts and dates


def display_bytes(transliterated: Column, content: Column, raw: Column) -> Column:
    return F.coalesce(F.nullif(transliterated, F.lit(0)), content, raw)


def _fixed(x: Column, digits: int) -> Column:
    """A number of 0 and more to so many digits: the exact value of the double is rounded, halves up.

    x * 10**digits is taken as an exact sum of two doubles, by splitting x into halves of its bits.
    """
    x, scale = x.cast("double"), float(10**digits)
    wide = x * F.lit(134217729.0)
    high = wide - (wide - x)
    low = x - high
    near = x * F.lit(scale)
    rest = (high * F.lit(scale) - near) + low * F.lit(scale)
    whole = F.floor(near)
    k = whole + (((near - whole) - F.lit(0.5)) + rest >= 0).cast("bigint")
    if not digits:
        return k.cast("string")
    unit = F.lit(10**digits)
    return F.concat(F.floor(k / unit).cast("string"), F.lit("."), F.lpad(F.pmod(k, unit).cast("string"), digits, "0"))


def format_bytes(n: Column) -> Column:
    """12.3 KB or 4.5 MB, decimal."""
    kb = n / F.lit(1e3)
    return F.when(n.isNull(), "").when(kb < 1000, F.concat(_fixed(kb, 1), F.lit(" KB"))).otherwise(F.concat(_fixed(kb / F.lit(1e3), 1), F.lit(" MB")))


def format_megabytes(n: Column) -> Column:
    return F.when(n.isNull(), "n/a").otherwise(F.concat(_fixed(n / F.lit(1e6), 1), F.lit(" MB")))


def axis_bytes(n: Column) -> Column:
    """A scale's label: whole MB, or GB from 1,000 MB on."""
    mb = n / F.lit(1e6)
    return F.when(mb >= 1000, F.concat(_fixed(mb / F.lit(1e3), 1), F.lit(" GB"))).otherwise(F.concat(_fixed(mb, 0), F.lit(" MB")))


def format_bytes_compact(n: Column) -> Column:
    return (
        F.when(n.isNull(), "n/a")
        .when(n == 0, "0")
        .when(n < 1_000, F.concat(n.cast("bigint").cast("string"), F.lit(" B")))
        .when(n < 1_000_000, F.concat(_fixed(n / F.lit(1e3), 0), F.lit(" KB")))
        .otherwise(F.concat(_fixed(n / F.lit(1e6), 1), F.lit(" MB")))
    )


def size_delta(old: Column, new: Column, least_percent: float = 0.1) -> Column:
    """What a change of size shows: nothing if it reads the same or is below least_percent."""
    old, new = F.coalesce(old, F.lit(0)), F.coalesce(new, F.lit(0))
    a, b = format_bytes_compact(old), format_bytes_compact(new)
    percent = (new - old) / F.nullif(old, F.lit(0)) * 100
    arrow = F.when(percent >= 0, "↑").otherwise("↓")
    return (
        F.when((old == 0) | (new == 0), F.concat(F.lit(" ("), a, F.lit("→"), b, F.lit(")")))
        .when((a == b) | (F.abs(percent) < least_percent), "")
        .otherwise(F.concat(F.lit(" ("), a, F.lit(" → "), b, F.lit(", "), arrow, F.lit(" "), _fixed(F.abs(percent), 1), F.lit("%)")))
    )


def percent_change(delta: Column, base: Column) -> Column:
    return F.lit(100.0) * delta / F.nullif(base, F.lit(0))


def change_text(percent: Column, old: Column) -> Column:
    """How a figure has changed from its old reading; empty if unknown."""
    arrow = F.when(percent >= 0, "↑").otherwise("↓")
    return F.when(percent.isNull(), "").otherwise(F.concat(F.lit(" ("), arrow, F.lit(" "), _fixed(F.abs(percent), 1), F.lit("% from "), old, F.lit(")")))


def stats_label(size: Column, texts: Column, pages: Column, date: Column) -> Column:
    """(size, n texts, n pages, month), without the parts that are null or empty."""
    plural = lambda n, one: F.when(n.isNotNull(), F.concat(n.cast("string"), F.lit(" "), F.when(n == 1, one).otherwise(one + "s")))
    parts = F.concat_ws(", ", format_bytes(size), plural(texts, "text"), plural(pages, "page"), F.nullif(F.substr(date, F.lit(1), F.lit(7)), F.lit("")))
    return F.when(size.isNull(), "").otherwise(F.concat(F.lit("("), parts, F.lit(")")))


def html_escape(x: Column) -> Column:
    """Text as it may stand in HTML, in quotes too; null is empty."""
    out = F.coalesce(x.cast("string"), F.lit(""))
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(mark), F.lit(name))
    return out


def collated(title: Column) -> Column:
    """A title to sort as people do: by the root order of Unicode, not by code points."""
    return F.collate(title, "UNICODE")


def is_complete(content: Column, end: str = "</mediawiki>", within: int = 64) -> Column:
    """Whether a file's last bytes hold the mark that ends it."""
    data = content.cast("binary")
    return F.coalesce(F.contains(F.decode(F.substring(data, -within, within), "ISO-8859-1"), F.lit(end)), F.lit(False))


def tick_step(lo: Column, hi: Column, count: int) -> Column:
    """The step of a scale: 1, 2, 5 or 10 times a power of ten."""
    raw = (hi - lo) / count
    size = F.pow(F.lit(10.0), F.floor(F.log10(raw)))
    norm = raw / size
    return F.when(norm >= 5, 10.0).when(norm >= 2, 5.0).when(norm >= 1, 2.0).otherwise(1.0) * size


def fixed_ticks(lo: Column, hi: Column, step: Column) -> Column:
    """The multiples of a step from lo to hi; lo alone if there are none."""
    first, last = F.ceil(lo / step), F.floor(hi / step)
    return F.when(first <= last, F.transform(F.sequence(first, last), lambda k: (k * step).cast("double"))).otherwise(F.array(lo.cast("double")))


def months_between(first: Column, last: Column) -> Column:
    """Months from first to last, both included."""
    return (F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first) + 1


def month_sequence(first: Column, last: Column) -> Column:
    """The first days of the months from first to last, both included."""
    return F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))


def parse_timestamp(iso: Column) -> Column:
    return F.try_to_timestamp(iso, F.lit("yyyy-MM-dd'T'HH:mm:ssX"))


def identifier_date(x: Column) -> Column:
    """The date in the last YYYYMMDD of an identifier."""
    return F.try_to_timestamp(F.regexp_extract(x, r"(\d{8})\D*$", 1), F.lit("yyyyMMdd")).cast("date")


def is_local_host(host: Column) -> Column:
    """Loopback and private addresses."""
    return F.lower(host).rlike(r"^(localhost|127\.\d+\.\d+\.\d+|\[?::1\]?|10\.\d+\.\d+\.\d+|192\.168\.\d+\.\d+|172\.(1[6-9]|2\d|3[01])\.\d+\.\d+)$")
