from pyspark.sql import functions as F

from quarrystone.functions import text as X
from quarrystone.functions import translit, wikitext


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(make(F.col("x")).alias("y")).first()["y"]


def test_category_links(spark):
    text = "[[वर्गः:A]] [[ वर्गः : B b |key]] [[वर्गः: C ]] [[वर्ग:D]] [[x:E]] [[वर्गः:A]]"
    assert one(spark, text, lambda x: X.category_links(x, "वर्गः")) == ["A", "B b", "C", "A"]
    assert one(spark, text, lambda x: X.direct_categories(x, "वर्गः")) == ["A", "B b", "C"]
    assert one(spark, "[[a.c:Z]] [[abc:Y]]", lambda x: X.category_links(x, "a.c")) == ["Z"]


def test_excluded(spark):
    for title, want in (("वर्गः:Works", True), ("Works", True), ("Works 2", False), ("वर्गः:भारतीय-विकिस्रोतः-x", True), ("वर्गः:ग्रन्थकर्तारः-क", True), ("वर्गः:वेदाः", False)):
        assert one(spark, title, X.is_excluded) is want


def test_owning_index_and_numbers(spark):
    assert one(spark, "पृष्ठम्:A/b.pdf/12", X.owning_index) == "A/b.pdf" and one(spark, "पृष्ठम्:A", X.owning_index) is None
    for title, want in (("p:A/१२", 12), ("p:A/7", 7), ("p:A/x", None), ("p:A", None), ("p:A/7b", None)):
        assert one(spark, title, X.leaf_number) == want
    for s, want in ((" ५ ", 5), ("12", 12), ("", None), ("a", None), ("1.5", None)):
        assert one(spark, s, X.parse_int) == want


def test_pages_tags(spark):
    text = '<pages index="A b" from=1 to="३" /> <pages.index=B include="1,3,5-8,x,9-2" /><PAGES from=2 index=C/> <pages from=1/> <pages index="" to=2/> <pages index=D include="" />'
    got = [(r.index_title, r.from_n, r.to_n, r.include) for r in one(spark, text, X.transclusion_ranges)]
    assert got == [("A b", 1, 3, None), ("B", None, None, [1, 3, 5, 6, 7, 8]), ("C", 2, None, None), ("D", None, None, None)]
    assert one(spark, text, X.first_attribute_indexes) == ["A b", "B", "D"]


def test_templates_and_tags(spark):
    assert one(spark, "a<noinclude>x\ny</noinclude>b<includeonly>c</includeonly><noinclude/>", X.transclusion_body) == "abc"
    assert one(spark, "q<onlyinclude>a</onlyinclude>r<ONLYINCLUDE >b</onlyinclude>", X.transclusion_body) == "ab"
    assert one(spark, " some_name x", X.template_name) == "Some name x"
    assert one(spark, "<TD class='a'>x</td> a < b <b>y<b><br/> <code>z</code>", X.strip_leftover_tags) == "x a < b y <code>z</code>"
    assert one(spark, " # REDIRECT [[ Target |x]]", X.redirect_target) == "Target" and one(spark, "no [[x]]", X.redirect_target) is None


NAV = [
    ("a\nb\nc\nd\ntext that ends.", "a\nb\nc\nd\ntext that ends."),
    ("x.\n\na\n\nb\nc\n\n\nd\ne\n\nlong text here.", "x.\n\n\nlong text here."),
    ("a\nb\nc\nd\ne", ""),
    ("\n\na\nb\nc\nd\ne\n\n", "\n\n\n"),
    ("a\nb\nc।\nd\ne\nf", "a\nb\nc।\nd\ne\nf"),
    ("a\nb\nc\nd\ne\n" + "w" * 40, "w" * 40),
    ("", ""),
]


def test_navigation_lines(spark):
    for text, want in NAV:
        assert wikitext.without_nav_lines(text) == want
        assert one(spark, text, X.strip_nav_lines) == want


def test_urls(spark):
    text = "see [http://www.A.org:80/x?y it], https://b.net/p). {{http://c.de/}} http://d.fr]"
    assert one(spark, text, lambda x: F.transform(X.urls_in(x), X.url_host)) == ["a.org:80", "b.net", "c.de", "d.fr"]
    assert one(spark, "a b/~*(अ)", lambda x: X.page_url("w/", x)) == "w/a_b/~%2A%28%E0%A4%85%29"
    for host, want in (("localhost", True), ("192.168.1.9", True), ("172.32.0.1", False), ("example.org", False)):
        assert one(spark, host, X.is_local_host) is want


def test_formats(spark):
    for n, a, b in ((None, "", "n/a"), (0, "0.0 KB", "0"), (999, "1.0 KB", "999 B"), (39_400, "39.4 KB", "39 KB"), (2_500_000, "2.5 MB", "2.5 MB")):
        assert (one(spark, n, X.format_bytes, "bigint"), one(spark, n, X.format_bytes_compact, "bigint")) == (a, b)
    delta = lambda a, b: spark.createDataFrame([(a, b)], "a bigint, b bigint").select(X.size_delta(F.col("a"), F.col("b")).alias("y")).first()["y"]
    assert [delta(0, 400_000), delta(400_000, 480_000), delta(39_100, 39_200), delta(891_499, 891_502), delta(5_000, 0)] == [" (0→400 KB)", " (400 KB → 480 KB, ↑ 20.0%)", "", "", " (5 KB→0)"]


def test_parser_functions():
    pf = wikitext.parser_functions
    assert pf("{{#if: |a|b}}{{#if:x|a|b}}{{#if:x|a}}") == "baa"
    assert pf("{{#ifeq: a |a|y|n}}{{#ifeq:a|b|y}}") == "y" and pf("{{#ifexist:T|y|n}}", {"T"}) == "y"
    assert pf("{{#switch:b|a=1|b=2|#default=3}}{{#switch:z|a=1|#default=3}}{{#switch:z|a=1|last}}") == "23last"
    assert pf("{{#if:x|{{#if:|p|q}}|r}}") == "q" and pf("{{#if:x|[[a|b]]|c}}") == "[[a|b]]" and pf("{{#if:x|a") == "{{#if:x|a" and pf("{{#expr:1}}") == "{{#expr:1}}"


def test_expansion():
    t = {"Box": "<{{{1|none}}}|{{{name|}}}>", "Self": "x{{self}}", "Two": "{{box|{{{1}}}}}", "Verse line": "v"}
    assert wikitext.expand("{{box|a}}{{Box|name=b}}{{ box }}", t) == "<a|><none|b><none|>"
    assert wikitext.expand("{{box|name=n|p}}", t) == "<none|n>"  # positions count all parameters
    assert wikitext.expand("{{two|q}} {{verse_line}} {{unknown|x}}", t) == "<q|> v {{unknown|x}}"
    deep = wikitext.expand("{{self}}", t)
    assert deep.count("x") == wikitext.DEPTH
    assert wikitext.expand("{{PAGENAME}}-{{ SUBPAGENAME }}-{{BASEPAGENAME}}-{{NAMESPACE}}{{TALKSPACE}}", {}, "A b/c") == "A b/c-c-A b-Talk"


def test_strip():
    assert wikitext.strip("'''a''' [[B|c]] [[D]] [[Category:X|k]]<ref>r</ref> [http://x.y label]<!-- n --> {{left|over}}<b>e") == "a c D  label e"
    assert wikitext.strip("== Head ==\n* item one is here.\n<poem>l</poem>") == "Head\nitem one is here.\nl"


def test_transliteration():
    t = translit.transliterate
    assert t("रामः") == "rāmaḥ" and t("कृष्ण") == "kṛṣṇa" and t("वाक् ॐ अ१२।") == "vāk oṃ a12."
    assert t("ज्ञानम्", "hk") == "jJAnam" and t("ऋषि", "slp1") == "fzi" and t("राम x", "devanagari") == "राम x" and t("") == ""


def test_sizes_of_pages(spark):
    pages = spark.createDataFrame([("A", "{{T|b}} अ [[Category:Q]]"), ("B", None), ("C", "")], "title string, text string")
    got = {r.title: (r.stripped, r.content_bytes, r.transliterated_bytes) for r in wikitext.with_text(pages, {"T": "<{{{1}}}>"}, transliterated=True).collect()}
    assert got["A"] == (" अ ", 5, 3) or got["A"][0].strip().endswith("अ")
    assert got["B"][0] == "" and got["C"] == ("", 0, 0)


def test_include_ranges_end_somewhere(spark):
    got = spark.range(1).select(F.size(X.include_numbers(F.lit("1-2000000000"))).alias("n"), X.include_numbers(F.lit("7,2000000-3000000,9-8,x")).alias("few")).first()
    assert got.n == X.LARGEST_LEAF and got.few == [7, 2000000]


def test_sizes_are_rounded_by_their_exact_value(spark):
    from decimal import ROUND_HALF_UP, Decimal

    numbers = [0, 1, 49, 50, 51, 150, 250, 350, 949, 950, 951, 1050, 1250, 999_949, 999_950, 999_951, 1_000_000, 1_050_000, 1_250_000, 123_456_789, 999_999_999_999]
    rows = spark.createDataFrame([(n,) for n in numbers], "n bigint").select("n", X.format_bytes(F.col("n")).alias("size"), X.format_megabytes(F.col("n")).alias("mb"), X.axis_bytes(F.col("n")).alias("axis")).collect()
    fixed = lambda x, d: str(Decimal(x).quantize(Decimal(1).scaleb(-d), ROUND_HALF_UP))
    for r in rows:
        kb = r.n / 1000
        assert r.size == (fixed(kb, 1) + " KB" if kb < 1000 else fixed(kb / 1000, 1) + " MB")
        mb = r.n / 1e6
        assert r.mb == fixed(mb, 1) + " MB" and r.axis == (fixed(mb / 1000, 1) + " GB" if mb >= 1000 else fixed(mb, 0) + " MB")
