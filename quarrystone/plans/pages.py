"""Link, tag, markup and URL operators on pages, and on wikitext made of the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.wikitext import with_text
from ..operators import audit, graph, transclude
from .registry import Tables, query


@query(r"""
SELECT page_id, unnest(regexp_extract_all(html, '<a href="/([^"]*)"', 1)) AS link FROM pages
""")
def tag_links(t: Tables):
    return t.pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<a href="/([^"]*)"'), F.lit(1))).alias("link"))


def _wiki(t: Tables):
    """A page of wikitext for every customer: links to its segment and nation, and <pages> tags."""
    return t.customer.select(
        F.col("c_name").alias("title"),
        F.concat(
            F.lit("Text.\n[[ Cat : "), "c_mktsegment", F.lit(" |key]] [[Cat:N"), "c_nationkey", F.lit("]][[Other:x]]\n<pages index=\"I"), (F.col("c_custkey") % 5).cast("string"), F.lit("\" from=2 to="), (F.col("c_custkey") % 7).cast("string"), F.lit(" /> <pages from=1 index=J include=\"1,4-5,z\"/><b>bold<td>")
        ).alias("text"),
    )


@query("""
SELECT c_mktsegment AS parent, c_name AS child FROM customer UNION ALL SELECT 'N' || c_nationkey, c_name FROM customer
""")
def category_edges(t: Tables):
    return graph.category_edges(_wiki(t).select("title", X.direct_categories(F.col("text"), "Cat").alias("categories")))


@query("""
SELECT c_name AS title, c_mktsegment AS tag, c_mktsegment = 'BUILDING' OR contains(c_mktsegment, 'MACH') AS excluded FROM customer UNION ALL SELECT c_name, 'N' || c_nationkey, false FROM customer
""")
def excluded_categories(t: Tables):
    tags = _wiki(t).select("title", F.explode(X.direct_categories(F.col("text"), "Cat")).alias("tag"))
    return tags.select("title", "tag", X.is_excluded(F.concat(F.lit("Cat:"), "tag"), ("BUILDING",), ("MACH",)).alias("excluded"))


@query("""
SELECT c_name AS title, 'I' || (c_custkey % 5) AS index_title, 2 AS from_n, CAST(c_custkey % 7 AS INTEGER) AS to_n, NULL AS include FROM customer
UNION ALL SELECT c_name, 'J', 1, NULL, '1,4,5' FROM customer
""")
def page_ranges(t: Tables):
    return transclude.page_ranges(_wiki(t)).withColumn("include", F.array_join(F.col("include").cast("array<string>"), ","))


@query("""
SELECT 'I' || (c_custkey % 5) AS index_title, CAST(count(*) AS BIGINT) AS n_pages FROM customer GROUP BY 1
""")
def index_pages(t: Tables):
    return transclude.index_pages(_wiki(t)).groupBy("index_title").agg(F.count(F.lit(1)).alias("n_pages"))


@query(r"""
SELECT page_id, regexp_replace(html, '</?(?:table|tr|td|th|tbody|thead|tfoot|caption|b|i|u|s|em|strong|br|hr|p|div|span|center|small|big|sub|sup|font|blockquote|poem)(?:\s[^<>]{0,120})?/?>', '', 'gi') AS text FROM pages
""")
def html_leftover_strip(t: Tables):
    return t.pages.select("page_id", X.strip_leftover_tags(F.col("html")).alias("text"))


@query("""
SELECT regexp_replace(lower(regexp_extract(url, '://([^/?#]*)', 1)), '^www[.]', '') AS host, CAST(count(*) AS BIGINT) AS n FROM pages GROUP BY 1
""")
def url_host_stats(t: Tables):
    return t.pages.groupBy(X.url_host(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH u AS (SELECT page_id, url, regexp_replace(lower(regexp_extract(url, '://([^/?#]*)', 1)), '^www[.]', '') AS host FROM pages)
SELECT CAST(page_id AS VARCHAR) AS title, CAST(CASE WHEN page_id % 2 = 0 THEN 2 ELSE 4 END AS INTEGER) AS n_urls, 1 AS repo_hits FROM u
WHERE host LIKE '%.com' AND host IN (SELECT host FROM u WHERE host LIKE '%.com') AND (page_id % 2 = 0 OR page_id % 3 = 0)
""")
def bulk_import(t: Tables):
    hosts = t.pages.select(X.url_host(F.col("url")).alias("host")).where("host like '%.com'")
    other = F.expr("if(page_id % 2 = 0, ' http://other.test/x', ' http://other.test/x http://b.test http://c.test/y).')")
    pages = t.pages.select(F.col("page_id").cast("string").alias("title"), F.concat(F.lit("see ["), "url", F.lit(" it]"), other, F.expr("if(page_id % 3 = 0, '\n== Source ==\n', '')")).alias("text"))
    return audit.bulk_imports(pages, hosts)


@query("""
SELECT c_name AS title, 'Name: ' || c_name || CASE WHEN c_custkey % 2 = 0 THEN ' even' ELSE ' odd' END || ' N' || c_nationkey || ' link' AS stripped,
  CAST(strlen('Name: ' || c_name || CASE WHEN c_custkey % 2 = 0 THEN ' even' ELSE ' odd' END || ' N' || c_nationkey || ' link') AS BIGINT) AS content_bytes FROM customer
""")
def wikitext_sizes(t: Tables):
    templates = {"Row": "'''Name:''' {{PAGENAME}} {{#ifeq:{{{1}}}|0|even|odd}}{{{missing|}}}", "Nation": "N{{{k|?}}}"}
    pages = t.customer.select(F.col("c_name").alias("title"), F.concat(F.lit("{{row|"), (F.col("c_custkey") % 2).cast("string"), F.lit("}} {{Nation|k="), "c_nationkey", F.lit("}} [[Target|link]]<!-- x -->[[Category:Y]]<b>")).alias("text"))
    return with_text(pages, templates).select("title", "stripped", "content_bytes")


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'Target ' || o_custkey END AS target FROM orders
""")
def redirect_targets(t: Tables):
    text = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit(" #REDIRECT [[ Target "), "o_custkey", F.lit("|x]]"))).otherwise(F.lit("plain [[Target]]"))
    return t.orders.select("o_orderkey", X.redirect_target(text).alias("target"))


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'only' ELSE 'ab' END AS body, 'Some name' AS name FROM part
""")
def template_bodies(t: Tables):
    text = F.when(F.col("p_partkey") % 3 == 0, F.lit("x<onlyinclude>on</onlyinclude>y<ONLYINCLUDE>ly</onlyinclude>")).otherwise(F.lit("a<noinclude>doc\n</noinclude><includeonly>b</includeonly><noinclude/>"))
    return t.part.select("p_partkey", X.transclusion_body(text).alias("body"), X.template_name(F.lit(" some_name")).alias("name"))
