"""Graph, tree, rollup, search and structural audit operators on the relational tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit, graph, paths, rollup, search, transclude
from .registry import Tables, query


def places(t: Tables):
    """Edges world -> region -> nation -> customer."""
    regions = t.region.select(F.lit("world").alias("parent"), F.concat(F.lit("r"), F.col("r_regionkey")).alias("child"))
    nations = t.nation.select(F.concat(F.lit("r"), F.col("n_regionkey")).alias("parent"), F.concat(F.lit("n"), F.col("n_nationkey")).alias("child"))
    customers = t.customer.select(F.concat(F.lit("n"), F.col("c_nationkey")).alias("parent"), F.concat(F.lit("c"), F.col("c_custkey")).alias("child"))
    return regions.unionByName(nations).unionByName(customers)


def upper(t: Tables):
    """The same without customers."""
    return places(t).where(~F.col("child").startswith("c"))


def kinds(t: Tables):
    """Edges brand -> type of parts, and type -> a type of the brand with the next number: a graph with several parents and cycles."""
    return t.part.select(F.col("p_brand").alias("parent"), F.col("p_type").alias("child")).unionByName(t.part.where("p_size <= 3").select(F.col("p_type").alias("parent"), F.col("p_brand").alias("child"))).distinct()


PLACES = """
places AS (
  SELECT 'world' AS parent, 'r' || r_regionkey AS child FROM region
  UNION ALL SELECT 'r' || n_regionkey, 'n' || n_nationkey FROM nation
  UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer)"""
KINDS = """
kinds AS (SELECT DISTINCT p_brand AS parent, p_type AS child FROM part
  UNION SELECT p_type, p_brand FROM part WHERE p_size <= 3)"""


@query(f"""
WITH RECURSIVE {PLACES}, reach(ancestor, node) AS (
  SELECT DISTINCT n, n FROM (SELECT unnest([parent, child]) AS n FROM places WHERE child NOT LIKE 'c%')
  UNION SELECT ancestor, child FROM reach JOIN places ON node = parent WHERE child NOT LIKE 'c%'),
filed AS (SELECT 'n' || c_nationkey AS node, o_orderkey AS item FROM orders JOIN customer ON o_custkey = c_custkey
  UNION ALL SELECT 'r' || n_regionkey, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
pairs AS (SELECT DISTINCT ancestor, item FROM reach JOIN filed USING (node))
SELECT ancestor, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS raw_bytes, CAST(count(*) AS BIGINT) AS count,
  max(strftime(o_orderdate, '%Y-%m-%d')) AS last_changed
FROM pairs JOIN orders ON item = o_orderkey GROUP BY ancestor
""")
def dag_rollup_distinct(t: Tables):
    """Items filed twice, under a nation and its region, count once for every ancestor."""
    customers = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    ordered = t.orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    filed = ordered.select(F.explode(F.array(F.concat(F.lit("n"), "n_nationkey"), F.concat(F.lit("r"), "n_regionkey"))).alias("node"), F.col("o_orderkey").alias("item"))
    items = t.orders.select(F.col("o_orderkey").alias("item"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("raw_bytes"), F.lit(1).alias("count"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("last_changed"))
    return rollup.distinct_rollup(graph.closure(upper(t)), filed, items, ("raw_bytes", "count"))


@query(f"""
WITH RECURSIVE {PLACES}, reach(ancestor, node) AS (
  SELECT DISTINCT n, n FROM (SELECT unnest([parent, child]) AS n FROM places)
  UNION SELECT ancestor, child FROM reach JOIN places ON node = parent)
SELECT ancestor, node FROM reach
""")
def dag_closure(t: Tables):
    return graph.closure(places(t))


@query(f"""
WITH RECURSIVE {KINDS}, reach(ancestor, node) AS (
  SELECT DISTINCT parent, child FROM kinds UNION SELECT ancestor, child FROM reach JOIN kinds ON node = parent)
SELECT ancestor AS node FROM reach WHERE ancestor = node
""")
def graph_cycles(t: Tables):
    return graph.on_cycle(kinds(t))


@query("""
SELECT p_type AS child, CAST(count(DISTINCT p_brand) AS BIGINT) AS n_parents FROM part GROUP BY p_type HAVING count(DISTINCT p_brand) > 1
""")
def multi_parent(t: Tables):
    return graph.multi_parented(t.part.select(F.col("p_brand").alias("parent"), F.col("p_type").alias("child")))


@query("""
SELECT 'c' || c_custkey AS node FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
""")
def dag_orphans(t: Tables):
    """Customers that no pending order files."""
    return graph.orphan_roots(t.customer.select(F.concat(F.lit("c"), "c_custkey").alias("node")), t.orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").cast("string").alias("parent"), F.concat(F.lit("c"), "o_custkey").alias("child")), "world")


@query(f"""
WITH {PLACES} SELECT parent, child FROM places WHERE child NOT LIKE 'c%' AND NOT (parent = 'r0' AND child = 'n0')
UNION SELECT 'r1', 'n0'
""")
def refiled_edges(t: Tables):
    edges = upper(t)
    nodes = edges.select(F.explode(F.array("parent", "child")).alias("node")).distinct()
    return graph.refile(edges, nodes, "n0", "r0", "r1")


@query(f"""
WITH RECURSIVE {PLACES}, up(node, top) AS (
  SELECT 'world', 'world' UNION ALL SELECT child, top FROM places JOIN up ON parent = node)
SELECT node, top FROM up
""")
def work_roots(t: Tables):
    tree = places(t).select(F.col("child").alias("node"), "parent").unionByName(t.spark.range(1).select(F.lit("world").alias("node"), F.lit(None).cast("string").alias("parent")))
    return graph.top_ancestors(tree)


@query("""
WITH RECURSIVE p AS (SELECT o_orderkey AS node, CASE WHEN o_orderkey % 7 <> 0 THEN lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) END AS target FROM orders),
chain(node, here) AS (SELECT node, node FROM p UNION ALL SELECT chain.node, p.target FROM chain JOIN p ON chain.here = p.node WHERE p.target IS NOT NULL)
SELECT node, max(here) AS last FROM chain GROUP BY node HAVING max(here) <> node
""")
def redirect_ends(t: Tables):
    """Every order points to its customer's next one, but for one in seven: chains end there."""
    from pyspark.sql import Window

    following = F.lead("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    pointers = t.orders.select(F.col("o_orderkey").alias("node"), F.when(F.col("o_orderkey") % 7 != 0, following).alias("target"))
    return graph.follow(pointers)


@query("""
WITH RECURSIVE edges AS (SELECT DISTINCT p_brand AS parent, p_type AS child FROM part UNION SELECT 'root', p_brand FROM part),
walk(node, path) AS (SELECT 'root', ['root'] UNION ALL SELECT child, list_append(path, child) FROM walk JOIN edges ON node = parent),
first AS (SELECT node, min(path) AS path FROM walk GROUP BY node)
SELECT CASE WHEN list_append(f.path, e.child) <> g.path THEN e.child || ':pointer' ELSE e.child END AS id, e.parent, e.child AS node,
  list_append(f.path, e.child) <> g.path AS is_pointer, array_to_string(list_append(f.path, e.child), '>') AS path
FROM edges e JOIN first f ON e.parent = f.node JOIN first g ON e.child = g.node
UNION ALL SELECT 'root', NULL, 'root', false, 'root'
""")
def display_tree(t: Tables):
    """First filings have content, later ones are pointers."""
    edges = t.part.select(F.col("p_brand").alias("parent"), F.col("p_type").alias("child")).unionByName(t.part.select(F.lit("root").alias("parent"), F.col("p_brand").alias("child")))
    return graph.display_rows(edges, "root").withColumn("path", F.array_join("path", ">"))


@query(f"""
WITH RECURSIVE {PLACES}, shown(node) AS (
  SELECT 'c' || c_custkey FROM customer WHERE contains(lower(c_name), '00007') UNION SELECT parent FROM shown JOIN places ON child = node)
SELECT DISTINCT node FROM shown
""")
def tree_filter(t: Tables):
    hits = t.customer.where(search.matches(F.col("c_name"), " 00007 ")).select(F.concat(F.lit("c"), "c_custkey").alias("node"))
    return search.filtered_tree(places(t), hits)


@query("""
SELECT 'c' || c_custkey AS node, 'world>r' || n_regionkey || '>n' || n_nationkey || '>c' || c_custkey AS path
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 9000
""")
def breadcrumbs(t: Tables):
    tree = places(t).select(F.col("child").alias("node"), "parent")
    hits = t.customer.where("c_acctbal > 9000").select(F.concat(F.lit("c"), "c_custkey").alias("node"))
    return search.breadcrumbs(tree, hits).select("node", F.array_join("path", ">").alias("path"))


@query("""
SELECT n_name AS name, contains(lower(n_name), 'an') AS is_part, lower(n_name) = 'nation_7' AS is_exact, false AS too_short FROM nation
""")
def search_contains_exact(t: Tables):
    n = F.col("n_name")
    return t.nation.select(n.alias("name"), F.lower(n).contains("an").alias("is_part"), search.matches(n, " Nation_7", exact=True).alias("is_exact"), search.matches(n, "an").alias("too_short"))


@query("""
SELECT p_type AS item, CAST(count(DISTINCT p_brand) AS BIGINT) AS n, array_to_string(list_sort(list(DISTINCT p_brand)), '|') AS places
FROM part GROUP BY p_type HAVING count(DISTINCT p_brand) > 1
""")
def multi_filed(t: Tables):
    return search.multi_filed(t.part.select(F.col("p_type").alias("item"), F.col("p_brand").alias("place"))).withColumn("places", F.array_join("places", "|"))


@query("""
WITH f AS (SELECT DISTINCT p_type AS item, p_brand AS place FROM part)
SELECT a.place, a.item, b.place AS other FROM f a JOIN f b ON a.item = b.item AND a.place <> b.place
""")
def sibling_places(t: Tables):
    return search.siblings(t.part.select(F.col("p_type").alias("item"), F.col("p_brand").alias("place")))


@query("""
SELECT doc_id, lang, CAST(rank AS INTEGER) AS rank FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rank FROM documents) WHERE rank <= 300
""")
def cap_300(t: Tables):
    return search.capped(t.documents.select("doc_id", "lang"), "lang", ["doc_id"])


@query("""
SELECT l_orderkey AS parent, l_returnflag AS tag FROM lineitem l
GROUP BY l_orderkey, l_returnflag HAVING count(*) = (SELECT count(*) FROM lineitem m WHERE m.l_orderkey = l.l_orderkey)
""")
def all_children_share(t: Tables):
    """Orders all of whose lines have one flag."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_partkey", "l_suppkey")
    keyed = rows.select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("title"), F.col("l_orderkey").cast("string").alias("parent"), F.col("l_returnflag").alias("tag"))
    return audit.shared_by_all(keyed.select("title", "parent"), keyed.select("title", "tag")).select(F.col("parent").cast("bigint").alias("parent"), "tag")


@query("""
WITH t AS (SELECT p_name AS title FROM part UNION SELECT p_name || ' ' || p_brand FROM part)
SELECT a.title, b.title AS prefix FROM t a JOIN t b ON starts_with(a.title, b.title || ' ')
""")
def prefix_families(t: Tables):
    titles = t.part.select(F.explode(F.array(F.col("p_name"), F.concat_ws(" ", "p_name", "p_brand"))).alias("title")).distinct()
    return audit.space_prefixes(titles)


@query("""
SELECT c_mktsegment AS stem, CAST(count(DISTINCT c_mktsegment || ' - ' || c_name) AS BIGINT) AS n FROM customer GROUP BY c_mktsegment HAVING count(DISTINCT c_name) >= 2
""")
def separator_families(t: Tables):
    titles = t.customer.select(F.explode(F.array(F.col("c_mktsegment"), F.concat(F.col("c_mktsegment"), F.lit(" - "), F.col("c_name")))).alias("title")).distinct()
    return audit.separator_families(titles)


@query("""
SELECT CAST(l_suppkey AS VARCHAR) AS title, CAST(count(*) AS BIGINT) AS n_mentions FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY l_suppkey
""")
def red_links(t: Tables):
    return audit.red_links(t.lineitem.select(F.col("l_suppkey").cast("string").alias("title")), t.supplier.where("s_acctbal > 0").select(F.col("s_suppkey").cast("string").alias("title")))


@query("""
SELECT l_orderkey AS index_title, CAST(count(*) AS BIGINT) AS n_leaves, arg_min(l_partkey, (l_linenumber, l_partkey)) AS first, arg_max(l_partkey, (l_linenumber, l_partkey)) AS last
FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority LIKE '1%') GROUP BY l_orderkey
""")
def broken_transclusions(t: Tables):
    used = t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("index_title"))
    leaves = t.lineitem.select(F.col("l_orderkey").alias("index_title"), F.col("l_partkey").alias("leaf_title"), F.col("l_linenumber").alias("n"))
    return audit.broken_transclusions(used, leaves, t.orders.where("o_orderpriority like '1%'").select(F.col("o_orderkey").alias("index_title")))


@query("""
SELECT p_brand, CAST(n AS BIGINT) AS n, p_partkey, CAST(rank AS INTEGER) AS rank FROM (
  SELECT p_brand, p_partkey, count(*) OVER (PARTITION BY p_brand) AS n, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rank FROM part) WHERE rank <= 5
""")
def group_samples(t: Tables):
    return audit.sample_of(t.part, "p_brand", "p_partkey", 5).select("p_brand", "n", "p_partkey", "rank")


@query("""
WITH w AS (SELECT string_split(p_name || ' ' || p_type || ' ' || p_brand, ' ') AS parts FROM part),
cut AS (SELECT k AS depth, array_to_string(parts[1:k], ' ') AS prefix FROM w, unnest(range(1, len(parts) + 1)) AS u(k)),
counted AS (SELECT prefix, CAST(depth AS INTEGER) AS depth, count(*) AS n FROM cut GROUP BY ALL HAVING count(*) >= 2)
SELECT prefix, depth, CAST(n AS BIGINT) AS n FROM counted c
WHERE NOT EXISTS (SELECT 1 FROM counted d WHERE d.depth = c.depth + 1 AND d.n = c.n AND starts_with(d.prefix, c.prefix || ' '))
""")
def token_groups(t: Tables):
    return audit.token_groups(t.part.select(F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("title")))


@query("""
SELECT o_orderkey AS title, l_orderkey || '/' || l_linenumber AS leaf_title FROM orders JOIN lineitem ON l_orderkey = o_orderkey
WHERE l_linenumber BETWEEN CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE -100 END AND CASE WHEN o_orderkey % 2 = 0 THEN 4 ELSE 100 END GROUP BY ALL
""")
def range_transclusion(t: Tables):
    ranges = t.orders.select(F.col("o_orderkey").alias("title"), F.col("o_orderkey").alias("index_title"), F.expr("if(o_orderkey % 3 = 0, 2, null)").alias("from_n"), F.expr("if(o_orderkey % 2 = 0, 4, null)").alias("to_n"), F.expr("cast(null as array<int>)").alias("include"))
    return transclude.resolved_leaves(ranges, _leaves(t))


@query("""
SELECT o_orderkey AS title, l_orderkey || '/' || l_linenumber AS leaf_title FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE list_contains([1, 3, 5, 6, 7], l_linenumber) GROUP BY ALL
""")
def include_set_join(t: Tables):
    from ..functions.text import include_numbers

    ranges = t.orders.select(F.col("o_orderkey").alias("title"), F.col("o_orderkey").alias("index_title"), F.lit(None).cast("int").alias("from_n"), F.lit(9).alias("to_n"), include_numbers(F.lit("1, 3,x,5-7,9-2")).alias("include"))
    return transclude.resolved_leaves(ranges, _leaves(t))


def _leaves(t: Tables):
    return t.lineitem.select(F.col("l_orderkey").alias("index_title"), F.concat_ws("/", "l_orderkey", "l_linenumber").alias("leaf_title"), F.col("l_linenumber").alias("n"))


@query("""
WITH leaves AS (SELECT l_orderkey AS o, l_linenumber AS n, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY ALL),
add AS (SELECT o, sum(q) AS q FROM leaves WHERE n <= 3 GROUP BY o)
SELECT o_orderkey AS title, CAST(round(o_totalprice) AS BIGINT) + CAST(coalesce(q, 0) AS BIGINT) AS raw_bytes FROM orders LEFT JOIN add ON o = o_orderkey
""")
def sizes_with_leaves(t: Tables):
    used = _leaves(t).where("n <= 3").select(F.col("index_title").alias("title"), "leaf_title").distinct()
    sizes = t.lineitem.groupBy(F.concat_ws("/", "l_orderkey", "l_linenumber").alias("leaf_title")).agg(F.sum("l_quantity").cast("bigint").alias("raw_bytes"))
    own = t.orders.select(F.col("o_orderkey").alias("title"), F.round("o_totalprice").cast("bigint").alias("raw_bytes"))
    return transclude.with_leaf_sizes(own, used, sizes, ("raw_bytes",))


@query("""
SELECT l_orderkey AS index_title, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS raw_bytes, CAST(count(*) AS BIGINT) AS content_bytes, CAST(0 AS BIGINT) AS transliterated_bytes,
  max(strftime(l_shipdate, '%Y-%m-%d')) AS last_changed, CAST(0 AS BIGINT) AS count
FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O') GROUP BY l_orderkey
""")
def leaf_rollup_untranscluded(t: Tables):
    leaves = t.lineitem.select(F.col("l_orderkey").alias("index_title"), F.col("l_quantity").cast("bigint").alias("raw_bytes"), F.lit(1).cast("bigint").alias("content_bytes"), F.lit(0).cast("bigint").alias("transliterated_bytes"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("last_changed"))
    return rollup.untranscluded_leaves(leaves, t.orders.where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("index_title")))


@query("""
SELECT CAST(count(DISTINCT k) AS BIGINT) AS n_works FROM (SELECT CAST(p_partkey AS VARCHAR) AS k FROM part UNION SELECT CAST(l_partkey AS VARCHAR) FROM lineitem UNION SELECT '') WHERE k <> ''
""")
def scanned_union_count(t: Tables):
    return rollup.scanned_works(t.part.select(F.col("p_partkey").cast("string")), t.lineitem.select(F.col("l_partkey").cast("string")), t.spark.range(1).select(F.lit("")))


@query("""
WITH tree AS (SELECT 'c' || c_custkey AS title, 'n' || c_nationkey AS parent FROM customer UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey FROM orders),
tags AS (SELECT 'c' || c_custkey AS title, c_mktsegment AS category FROM customer UNION ALL SELECT 'o' || o_orderkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 2 = 0 UNION ALL SELECT 'o' || o_orderkey, o_orderpriority FROM orders)
SELECT f.category, f.title, NOT (EXISTS (SELECT 1 FROM tags p WHERE p.title = t.parent AND p.category = f.category)) AS kept
FROM tags f JOIN tree t ON f.title = t.title
""")
def suppressed_filings(t: Tables):
    """A filing is suppressed where the parent has the same tag; no work's top is central here."""
    customers = t.customer.select(F.concat(F.lit("c"), "c_custkey").alias("title"), F.concat(F.lit("n"), "c_nationkey").alias("parent"), "c_custkey", "c_mktsegment")
    orders = t.orders.select(F.concat(F.lit("o"), "o_orderkey").alias("title"), F.concat(F.lit("c"), "o_custkey").alias("parent"), "o_orderkey", "o_custkey", "o_orderpriority")
    tree = customers.select("title", "parent").unionByName(orders.select("title", "parent"))
    own = orders.where("o_orderkey % 2 = 0").join(customers.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey")).select("title", F.col("c_mktsegment").alias("category"))
    tags = customers.select("title", F.col("c_mktsegment").alias("category")).unionByName(own).unionByName(orders.select("title", F.col("o_orderpriority").alias("category")))
    tops = tree.select("title", F.lit("world").alias("top"))
    return rollup.judged_filings(tags, tags, tree, tops, t.spark.range(0).select(F.lit("").alias("node")))


@query("""
WITH RECURSIVE edges AS (SELECT DISTINCT p_brand AS parent, p_brand || '/' || p_type AS child FROM part),
leaf AS (SELECT p_brand || '/' || p_type AS node, bool_and(p_size > 10) AS gone FROM part GROUP BY 1),
top AS (SELECT parent AS node FROM edges JOIN leaf ON child = node GROUP BY parent HAVING bool_and(gone))
SELECT node FROM leaf WHERE gone UNION ALL SELECT node FROM top
""")
def pruned_categories(t: Tables):
    """Types within a brand are emptied where every part is large; brands where all their types are."""
    kind = F.concat_ws("/", "p_brand", "p_type")
    edges = t.part.select(F.col("p_brand").alias("parent"), kind.alias("child")).distinct()
    filings = t.part.select(kind.alias("category"), F.col("p_partkey").alias("title"), (F.col("p_size") <= 10).alias("kept"))
    filings = filings.unionByName(t.part.select(F.col("p_brand").alias("category"), F.col("p_partkey").alias("title"), F.lit(False).alias("kept")))
    return rollup.pruned(edges, filings)


@query("""
SELECT o_orderkey AS item, NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber > 3) AS listed FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber > 3 AND l_returnflag = 'R')
""")
def orphan_sweep(t: Tables):
    tags = t.lineitem.where("l_linenumber > 3").select(F.col("l_orderkey").alias("title"), F.col("l_returnflag").alias("category"))
    return rollup.orphans(t.orders.select(F.col("o_orderkey").alias("item")), tags, t.spark.range(1).select(F.lit("R").alias("node")))


@query("""
SELECT 'c' || c_custkey AS title, CAST(count(o_orderkey) + 1 AS BIGINT) AS count FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey
UNION ALL SELECT 'o' || o_orderkey, 1 FROM orders
""")
def page_subtrees(t: Tables):
    tree = t.customer.select(F.concat(F.lit("c"), "c_custkey").alias("title"), F.lit(None).cast("string").alias("parent")).unionByName(t.orders.select(F.concat(F.lit("o"), "o_orderkey").alias("title"), F.concat(F.lit("c"), "o_custkey").alias("parent")))
    items = tree.select(F.col("title").alias("item"), F.lit(1).cast("bigint").alias("count"))
    return rollup.page_rollup(tree, items, ("count",), None)


@query("""
WITH u AS (SELECT page_id, list_filter(string_split(regexp_extract(url, '://[^/]*/([^?#]*)', 1), '/'), lambda x: x <> '') AS s FROM pages)
SELECT page_id, array_to_string(s[1:k], '/') AS ancestor, CAST(k - 1 AS INTEGER) AS depth FROM u, unnest(range(1, len(s))) AS r(k)
""")
def url_path_prefixes(t: Tables):
    path = F.array_join(F.filter(F.split(F.regexp_extract("url", "://[^/]*/([^?#]*)", 1), "/"), lambda x: x != ""), "/")
    keyed = t.pages.select("page_id", path.alias("path"))
    return keyed.join(paths.path_prefixes(keyed.select("path").distinct()), "path").select("page_id", "ancestor", "depth")


@query("""
SELECT 'r' || r_regionkey || '/n' || n_nationkey AS title, CASE WHEN r_regionkey % 2 = 0 THEN 'r' || r_regionkey END AS parent FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT 'r' || r_regionkey, NULL FROM region WHERE r_regionkey % 2 = 0
UNION ALL SELECT 'r' || r_regionkey || '/n' || n_nationkey || ' /c' || c_custkey, 'r' || r_regionkey || '/n' || n_nationkey FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def path_forest(t: Tables):
    """Regions of odd keys have no page, so that their nations stay on top; customers' paths have a stray blank."""
    nation = F.concat(F.lit("r"), "n_regionkey", F.lit("/n"), "n_nationkey")
    titles = (
        t.nation.select(nation.alias("title"))
        .unionByName(t.region.where("r_regionkey % 2 = 0").select(F.concat(F.lit("r"), "r_regionkey").alias("title")))
        .unionByName(t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.concat(nation, F.lit(" /c"), "c_custkey").alias("title")))
    )
    return paths.page_tree(titles.select("title", F.lit(None).cast("string").alias("redirect_target"), F.lit(0).alias("position")))


@query(f"""
WITH RECURSIVE {PLACES}, reach(ancestor, node) AS (
  SELECT DISTINCT n, n FROM (SELECT unnest([parent, child]) AS n FROM places) UNION SELECT ancestor, child FROM reach JOIN places ON node = parent),
s AS (SELECT ancestor, CAST(count(*) AS BIGINT) AS count FROM reach WHERE node LIKE 'c%' GROUP BY ancestor)
SELECT count, 'root' AS scope FROM s WHERE ancestor = 'r1' UNION ALL SELECT count, 'all' FROM s WHERE ancestor = 'world'
""")
def spliced_root(t: Tables):
    edges = places(t)
    filings = edges.where(F.col("child").startswith("c")).select(F.col("child").alias("node"), F.col("child").alias("item"))
    totals = rollup.distinct_rollup(graph.closure(edges), filings, filings.select("item", F.lit(1).alias("count")), ("count",), None)
    return rollup.spliced_root(totals, edges, "world", "r1")


@query("""
SELECT CAST(count(*) FILTER (c_custkey % 10 <> 0) AS BIGINT) AS pages, CAST(count(*) FILTER (c_custkey % 10 <> 0 AND c_custkey % 3 = 0) AS BIGINT) AS texts,
  CAST(sum(CASE WHEN c_custkey % 10 <> 0 THEN c_nationkey ELSE 0 END) AS BIGINT) AS raw_bytes, CAST(count(*) AS BIGINT) AS records, CAST(count(DISTINCT c_mktsegment) AS BIGINT) AS categories FROM customer
""")
def corpus_stats(t: Tables):
    pages = t.customer.select(F.col("c_name").alias("title"), F.expr("if(c_custkey % 10 = 0, 'x', null)").alias("redirect_target"), F.col("c_nationkey").cast("bigint").alias("raw_bytes"))
    tree = t.customer.select(F.col("c_name").alias("title"), F.expr("if(c_custkey % 3 = 0, null, 'p')").alias("parent"))
    return rollup.corpus_stats(pages, tree, t.customer.select(F.col("c_mktsegment").alias("title")))


@query("""
SELECT 'multi_parent' AS "check", p_type AS subject, CAST(count(DISTINCT p_brand) AS BIGINT) AS n FROM part GROUP BY p_type HAVING count(DISTINCT p_brand) > 1
UNION ALL SELECT 'families', c_mktsegment, CAST(count(DISTINCT c_name) AS BIGINT) FROM customer GROUP BY c_mktsegment HAVING count(DISTINCT c_name) >= 2
UNION ALL SELECT 'idle', 'c' || c_custkey, 1 FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
""")
def audit_findings(t: Tables):
    return audit.findings(multi_parent=multi_parent(t), families=separator_families(t), idle=dag_orphans(t))
