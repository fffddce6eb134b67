"""Audits, reports, publication checks and exports read back, on the relational tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import audit, checks, diff, graph, paths, rollup, snapshot
from ..sources import dump, tables
from ..staging import shared_dir
from .registry import Tables, query


def _name(n: Column) -> Column:
    return F.concat(F.lit("n"), F.lpad(n.cast("string"), 2, "0"))


@query("""
WITH RECURSIVE k AS (SELECT n_nationkey AS n FROM nation),
e AS (SELECT 'n' || lpad(CAST(n AS VARCHAR), 2, '0') AS parent, 'n' || lpad(CAST((3 * n + 1) % 25 AS VARCHAR), 2, '0') AS child FROM k
  UNION SELECT 'n' || lpad(CAST(n AS VARCHAR), 2, '0'), 'n' || lpad(CAST((n + 5) % 25 AS VARCHAR), 2, '0') FROM k WHERE n % 4 = 0),
p(node, path) AS (SELECT n, [n] FROM (SELECT DISTINCT unnest([parent, child]) AS n FROM e) UNION ALL SELECT child, list_append(path, child) FROM p JOIN e ON node = parent WHERE NOT list_contains(path, child)),
best AS (SELECT node, min(path) AS path FROM p GROUP BY node)
SELECT array_to_string(list_append(path[list_position(path, child):], child), '>') AS path FROM best JOIN e ON node = parent WHERE list_contains(path, child)
""")
def cycle_paths(t: Tables):
    n = F.col("n_nationkey")
    edges = t.nation.select(_name(n).alias("parent"), _name((n * 3 + 1) % 25).alias("child")).unionByName(t.nation.where("n_nationkey % 4 = 0").select(_name(n).alias("parent"), _name((n + 5) % 25).alias("child")))
    return graph.cycle_paths(edges).select(F.array_join("path", ">").alias("path"))


@query("""
SELECT 'Page:' || c_name AS title, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment || '|N' || c_nationkey ELSE 'N' || c_nationkey END AS categories FROM customer WHERE c_custkey % 3 < 2
""")
def tagged_leaves(t: Tables):
    link = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("[[Cat:"), "c_mktsegment", F.lit("]]"))).otherwise("")
    text = F.concat(F.lit("scan "), link, F.when(F.col("c_custkey") % 3 < 2, F.concat(F.lit(" [[Cat:N"), "c_nationkey", F.lit("]]"))).otherwise(""))
    leaves = t.customer.select(F.concat(F.lit("Page:"), "c_name").alias("title"), X.direct_categories(text, "Cat").alias("categories"))
    return audit.tagged_leaves(leaves).withColumn("categories", F.array_join("categories", "|"))


def _family_pages(t: Tables):
    key = F.col("c_custkey")
    pages = t.customer.select(F.col("c_name").alias("title"), F.when(key % 7 == 0, F.lit("elsewhere")).alias("redirect_target"))
    parent = F.when(key % 10 == 1, F.concat(F.lit("Customer#"), F.lpad((key % 40 * 50).cast("string"), 9, "0")))
    return pages, t.customer.select(F.col("c_name").alias("title"), parent.alias("parent"))


_FAMILIES = (("ones", "^Customer#.*1$"), ("hundreds", "^Customer#.*00$"), ("none", "^Nobody.*$"))


@query("""
WITH c AS (SELECT c_name AS title, c_custkey % 7 = 0 AS redirect, CASE WHEN c_custkey % 10 = 1 THEN 'Customer#' || lpad(CAST(c_custkey % 40 * 50 AS VARCHAR), 9, '0') END AS parent FROM customer),
f AS (SELECT CASE WHEN title LIKE '%1' THEN 'ones' ELSE 'hundreds' END AS family, title, parent FROM c WHERE title LIKE '%1' OR title LIKE '%00')
SELECT family, 'unparented' AS problem, min(title) AS subject, CAST(count(*) AS BIGINT) AS n FROM f WHERE parent IS NULL GROUP BY family
UNION ALL SELECT family, CASE WHEN c.title IS NULL THEN 'missing' ELSE 'redirect' END, f.parent, count(*) FROM f LEFT JOIN c ON f.parent = c.title WHERE f.parent IS NOT NULL AND (c.title IS NULL OR c.redirect) GROUP BY ALL
UNION ALL SELECT 'none', 'dead', NULL, 0
""")
def family_problems(t: Tables):
    return audit.family_problems(*_family_pages(t), list(_FAMILIES))


@query("""
SELECT o_orderkey AS index_title, CAST(round(o_totalprice) AS BIGINT) + CAST(coalesce(q, 0) AS BIGINT) AS raw_bytes, CAST(coalesce(n, 0) AS BIGINT) AS content_bytes, CAST(0 AS BIGINT) AS transliterated_bytes, CAST(1 AS BIGINT) AS count,
  CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS BIGINT) AS text_count, greatest(strftime(o_orderdate, '%Y-%m-%d'), coalesce(last, '')) AS last_changed
FROM orders LEFT JOIN (SELECT l_orderkey, sum(CAST(l_quantity AS BIGINT)) AS q, count(*) AS n, max(strftime(l_shipdate, '%Y-%m-%d')) AS last FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
""")
def index_item_stats(t: Tables):
    zero = F.lit(0).cast("bigint")
    shells = t.orders.select(F.col("o_orderkey").alias("index_title"), F.round("o_totalprice").cast("bigint").alias("raw_bytes"), zero.alias("content_bytes"), zero.alias("transliterated_bytes"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("last_changed"))
    leaves = t.lineitem.groupBy(F.col("l_orderkey").alias("index_title")).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("raw_bytes"), F.count(F.lit(1)).alias("content_bytes"), F.lit(0).cast("bigint").alias("transliterated_bytes"), F.max(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("last_changed"))
    return rollup.index_items(shells, leaves, t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("index_title")))


@query("""
SELECT c_custkey AS item, CAST(CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END AS INTEGER) AS text_count FROM customer
""")
def text_counts(t: Tables):
    tree = t.customer.where("c_custkey % 3 <> 1 or c_custkey % 4 = 0").select(F.col("c_custkey").alias("title"), F.when(F.col("c_custkey") % 4 != 0, F.col("c_custkey") - 1).alias("parent"))
    return rollup.text_counts(t.customer.select(F.col("c_custkey").alias("item"), F.lit(7).alias("text_count")), tree)


@query("""
SELECT 'महाभारतम्-' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || '-R' || n_regionkey || '-' || lower(n_name) AS title, CASE WHEN n_regionkey < 3 THEN 'महाभारतम्/R' || n_regionkey END AS parent FROM nation
UNION ALL SELECT 'महाभारतम्/R' || r_regionkey, NULL FROM region WHERE r_regionkey < 3
""")
def flat_families(t: Tables):
    members = t.nation.select(F.concat(F.lit("महाभारतम्-"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"), F.lit("-R"), "n_regionkey", F.lit("-"), F.lower("n_name")).alias("title"))
    ends = t.region.where("r_regionkey < 3").select(F.concat(F.lit("महाभारतम्/R"), "r_regionkey").alias("title"))
    pages = members.unionByName(ends).select("title", F.lit(None).cast("string").alias("redirect_target"), F.xxhash64("title").alias("position"))
    return paths.page_tree(pages).select("title", "parent")


@query("""
WITH t AS (SELECT c_custkey AS k, CASE WHEN c_custkey > 10 THEN c_custkey // 10 END AS p FROM customer),
r AS (SELECT k, p FROM t WHERE k % 4 = 0)
SELECT 'c' || t.k AS title, CASE WHEN r.k IS NULL THEN 'c' || t.p ELSE 'c' || r.p END AS parent FROM t LEFT JOIN r ON t.p = r.k WHERE t.k % 4 <> 0
""")
def skipped_redirects(t: Tables):
    key = F.col("c_custkey")
    tree = t.customer.select(F.concat(F.lit("c"), key).alias("title"), F.when(key > 10, F.concat(F.lit("c"), F.floor(key / 10))).alias("parent"))
    return paths.skip_redirects(tree, t.customer.where("c_custkey % 4 = 0").select(F.concat(F.lit("c"), key).alias("title")))


@query("""
SELECT CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE p_type END AS family, CAST(count(*) AS BIGINT) AS n FROM part WHERE p_size % 3 = 0 AND p_partkey % 5 <> 0 GROUP BY 1
""")
def unresolved_paths(t: Tables):
    first = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(" "), "p_brand", F.lit(" "))).otherwise(F.col("p_type"))
    title = F.concat(first, F.lit("/x/"), "p_partkey")
    tree = t.part.select(title.alias("title"), F.when(F.col("p_size") % 3 != 0, "somewhere").alias("parent"))
    return paths.unresolvable(tree, t.part.where("p_partkey % 5 = 0").select(title.alias("title")))


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN NULL ELSE 'Book/' || l_orderkey END AS index_title FROM lineitem
""")
def owning_indexes(t: Tables):
    title = F.when(F.col("l_linenumber") == 1, F.concat(F.lit("Page:Book "), "l_orderkey")).otherwise(F.concat(F.lit("Page:Book/"), "l_orderkey", F.lit("/"), "l_linenumber"))
    return t.lineitem.select("l_orderkey", "l_linenumber", X.owning_index(title).alias("index_title"))


@query("""
WITH w(name, lo, hi) AS (VALUES ('first', TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-08 12:00:00'), ('second', TIMESTAMP '2024-01-08', TIMESTAMP '2024-01-20')),
r AS (SELECT name, CASE WHEN user_id % 3 = 0 THEN 'u' || user_id WHEN user_id % 3 = 1 THEN '10.0.0.' || user_id ELSE '?' END AS editor,
  CASE WHEN user_id % 5 = 0 THEN '' ELSE left('edited in a long session, with a comment that is longer than seventy signs: ' || event_type, 70) END AS comment, event_type || user_id % 11 AS title FROM events JOIN w ON ts >= lo AND ts < hi),
c AS (SELECT name, 'editor' AS what, editor AS value, count(*) AS n FROM r GROUP BY ALL UNION ALL SELECT name, 'comment', comment, count(*) FROM r GROUP BY ALL UNION ALL SELECT name, 'title', title, count(*) FROM r GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY name, what ORDER BY n DESC, value) AS rank FROM c)
SELECT name, what, value, CAST(n AS BIGINT) AS n, CAST(rank AS INTEGER) AS rank FROM k WHERE rank <= CASE WHEN what = 'title' THEN 8 ELSE 6 END
UNION ALL SELECT name, 'revisions', '', count(*), 1 FROM r GROUP BY name UNION ALL SELECT name, 'titles', '', count(DISTINCT title), 1 FROM r GROUP BY name
""")
def burst_profile(t: Tables):
    windows = t.spark.sql("SELECT * FROM VALUES ('first', TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-08 12:00:00'), ('second', TIMESTAMP '2024-01-08', TIMESTAMP '2024-01-20') AS w(name, lo, hi)")
    user = F.col("user_id")
    comment = F.when(user % 5 != 0, F.concat(F.lit("edited in a long session, with a comment that is longer than seventy signs: "), "event_type"))
    rows = t.events.select(F.col("ts").cast("timestamp").alias("timestamp"), dump.editor(F.when(user % 3 == 0, F.concat(F.lit("u"), user)), F.when(user % 3 == 1, F.concat(F.lit("10.0.0."), user))).alias("editor"), comment.alias("comment"), F.concat("event_type", user % 11).alias("title"))
    return snapshot.burst_profile(rows, windows)


_STATS_SQL = """
s AS (SELECT o_orderdate >= TIMESTAMP '1998-01-01' AS late, count(*) AS count, count(DISTINCT o_custkey) AS text_count, count(*) FILTER (o_orderstatus = 'P') AS extra FROM orders GROUP BY 1)"""


@query(f"""
WITH {_STATS_SQL},
l AS (SELECT late, unnest(['central', 'central', 'all', 'all']) AS section, unnest(['count', 'text_count', 'count', 'text_count']) AS metric, unnest([count, text_count, count + CASE WHEN late THEN extra ELSE 0 END, text_count + CASE WHEN late THEN extra ELSE 0 END]) AS v FROM s)
SELECT a.section, a.metric, CAST(a.v AS BIGINT) AS old, CAST(b.v AS BIGINT) AS new, CAST(b.v - a.v AS BIGINT) AS delta, round(100.0 * (b.v - a.v) / nullif(a.v, 0), 6) AS percent FROM l a JOIN l b ON a.section = b.section AND a.metric = b.metric AND NOT a.late AND b.late
""")
def full_report(t: Tables):
    def snap(late: bool):
        day = F.to_timestamp(F.lit("1998-01-01"))
        one = t.orders.where(F.col("o_orderdate") >= day if late else F.col("o_orderdate") < day).agg(F.count(F.lit(1)).alias("count"), F.count_distinct("o_custkey").alias("text_count"), F.count_if(F.col("o_orderstatus") == "P").alias("extra"))
        every = F.struct((F.col("count") + F.col("extra")).alias("count"), (F.col("text_count") + F.col("extra")).alias("text_count"))
        return one.select(F.struct("count", "text_count").alias("root"), (every if late else F.when(F.lit(False), every)).alias("all"))

    return diff.full_report(snap(False), snap(True), ["count", "text_count"]).withColumn("percent", F.round("percent", 6))


def _roster(t: Tables, rebuilt: bool):
    """Orders of each customer; a rebuilt roster lacks some customers and has other segments for others."""
    own = t.customer.where("c_custkey % 50 <> 0") if rebuilt else t.customer.where("c_custkey % 75 <> 1")
    segment = F.when((F.col("c_custkey") % 20 == 3) & F.lit(rebuilt), F.lit("OTHER")).otherwise(F.col("c_mktsegment"))
    return own.select(F.col("c_custkey").alias("item"), F.array(segment).alias("categories"), F.lit(False).alias("orphaned"), F.abs("c_acctbal").cast("bigint").alias("bytes"), F.lit("").alias("last_changed"))


@query("""
WITH a AS (SELECT c_custkey AS k, CAST(trunc(abs(c_acctbal)) AS BIGINT) AS b FROM customer WHERE c_custkey % 75 <> 1), b AS (SELECT c_custkey AS k, CAST(trunc(abs(c_acctbal)) AS BIGINT) AS b FROM customer WHERE c_custkey % 50 <> 0),
m AS (SELECT 'bytes' AS what, (SELECT sum(b) FROM a) AS real, (SELECT sum(b) FROM b) AS rebuilt UNION ALL SELECT 'count', (SELECT count(*) FROM a), (SELECT count(*) FROM b)),
d AS (SELECT CASE WHEN a.k IS NULL THEN 'items added' WHEN b.k IS NULL THEN 'items removed' ELSE 'items recategorized' END AS what FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.k % 20 = 3)
SELECT what, CAST(real AS BIGINT) AS real, CAST(rebuilt AS BIGINT) AS rebuilt, round(100.0 * (rebuilt - real) / real, 6) AS percent FROM m
UNION ALL SELECT what, (SELECT count(*) FROM a), count(*), round(100.0 * count(*) / (SELECT count(*) FROM a), 6) FROM d GROUP BY what
""")
def reconstruction_error(t: Tables):
    rosters = _roster(t, False), _roster(t, True)
    stats = tuple(r.agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("count")) for r in rosters)
    return diff.reconstruction_error(*rosters, stats, ["bytes", "count"]).withColumn("percent", F.round("percent", 6))


@query("""
WITH v AS (SELECT strftime(min(o_orderdate), '%Y-%m-%d') AS content, strftime(max(o_orderdate), '%Y-%m-%d') AS newest, count(*) FILTER (o_orderstatus = 'X') AS none FROM orders)
SELECT 'version' AS check, '__code_version__' AS subject, 'missing' AS problem UNION ALL SELECT 'version', '__data_version__', 'no date'
UNION ALL SELECT 'log', newest, content FROM v WHERE newest <> content UNION ALL SELECT 'root', 'text_count', CAST(none AS VARCHAR) FROM v WHERE none <= 0
""")
def publish_checks(t: Tables):
    ends = t.orders.agg(F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("lo"))
    version = checks.stamped(t.spark.createDataFrame([("__code_version__", ""), ("__data_version__", "2020-01-01")], "field string, value string"), "today", None)
    version = version.unionByName(ends.select(F.lit("__content_version__").alias("field"), F.col("lo").alias("value")))
    root = t.orders.agg(F.count(F.lit(1)).alias("count"), F.count_if(F.col("o_orderstatus") == "X").alias("text_count"))
    named = lambda df, check, subject, problem: df.select(F.lit(check).alias("check"), F.col(subject).alias("subject"), F.col(problem).cast("string").alias("problem"))
    log = t.orders.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"))
    return named(checks.version_problems(version), "version", "field", "problem").unionByName(named(checks.log_behind(log, version), "log", "newest", "content")).unionByName(named(checks.root_problems(root, ("count", "text_count")), "root", "metric", "value"))


@query("""
WITH n AS (SELECT n_name AS name FROM nation UNION SELECT lower(n_name) FROM nation UNION SELECT n_name || ' é' FROM nation UNION SELECT lower(n_name) || ' f' FROM nation)
SELECT name, CAST(row_number() OVER (ORDER BY name COLLATE en) AS INTEGER) AS rank FROM n
""")
def collated_names(t: Tables):
    from pyspark.sql import Window

    name = F.col("n_name")
    names = t.nation.select(F.explode(F.array(name, F.lower(name), F.concat(name, F.lit(" é")), F.concat(F.lower(name), F.lit(" f")))).alias("name")).distinct()
    # a list of names on display
    return names.withColumn("rank", F.row_number().over(Window.orderBy(X.collated(F.col("name")))))


@query("""
SELECT p_type AS "group", CAST(count(*) AS BIGINT) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, p_type) AS INTEGER) AS rank FROM part GROUP BY p_type QUALIFY rank <= 4
""")
def largest_groups(t: Tables):
    return audit.largest_groups(t.part.select(F.col("p_type").alias("group")), "group", 4)


def _display(t: Tables):
    regions = t.region.select(F.lit("world").alias("parent"), F.concat(F.lit("r"), "r_regionkey").alias("child"))
    nations = t.nation.select(F.concat(F.lit("r"), "n_regionkey").alias("parent"), F.concat(F.lit("n"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("child"))
    twice = t.nation.where("n_nationkey % 6 = 0").select(F.lit("r4").alias("parent"), F.concat(F.lit("n"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("child"))
    return graph.display_rows(regions.unionByName(nations).unionByName(twice).distinct(), "world")


@query("""
SELECT DISTINCT 'r4' AS id, 'r4' AS node, false AS is_pointer FROM region
UNION SELECT CASE WHEN n_nationkey % 6 = 0 AND n_regionkey < 4 THEN 'n' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || ':pointer' ELSE 'n' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END,
  'n' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0'), n_nationkey % 6 = 0 AND n_regionkey < 4 FROM nation WHERE n_regionkey = 4 OR n_nationkey % 6 = 0
""")
def deep_walk(t: Tables):
    return graph.below(_display(t), "r4").select("id", "node", "is_pointer")


@query("""
SELECT 'world' AS id, 'world' AS title UNION SELECT 'r' || r_regionkey, 'r' || r_regionkey FROM region
UNION SELECT 'n' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0'), 'n' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') FROM nation UNION SELECT c_name, c_name FROM customer
""")
def flat_nodes(t: Tables):
    filings = t.customer.select(F.concat(F.lit("n"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("category"), F.col("c_name").alias("item"))
    return graph.flat_nodes(_display(t), filings)


def _exported(t: Tables) -> str:
    """An export of a page for every customer, in the shared folder."""
    path = f"{shared_dir(t.spark)}/exports/{t.spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    key = F.col("c_custkey")
    pages = t.customer.select(
        F.lit("2024-01-01").alias("cutoff"), (key % 3).cast("int").alias("ns"), F.col("c_name").alias("title"), key.alias("page_id"), F.when(key % 5 == 0, F.lit("Target & more")).alias("redirect_target"),
        F.concat(F.lit(" <b>Balance</b> \n"), F.col("c_mktsegment"), F.lit(" & é ")).alias("text"), F.lit("2023-12-31T00:00:00Z").alias("timestamp"), (key * 10).alias("rev_id"),
    )
    dump.write_snapshots(pages, path)
    return f"{path}/cutoff=2024-01-01"


_EXPORT_SQL = """
SELECT c_custkey AS page_id, CAST(c_custkey % 3 AS INTEGER) AS ns, c_name AS title, {} ' <b>Balance</b> ' || chr(10) || c_mktsegment || ' & é ' AS text, '2023-12-31T00:00:00Z' AS timestamp, c_custkey * 10 AS rev_id FROM customer"""


@query(_EXPORT_SQL.format("CASE WHEN c_custkey % 5 = 0 THEN 'Target & more' END AS redirect_target,") + " WHERE c_custkey % 3 < 2")
def exported_pages(t: Tables):
    return dump.read_pages(t.spark, _exported(t), [0, 1])


@query(_EXPORT_SQL.format("CAST(0 AS INTEGER) AS position, '?' AS editor, NULL AS comment, true AS visible,"))
def exported_revisions(t: Tables):
    return dump.read_revisions(t.spark, _exported(t))


@query("""
WITH f AS (SELECT c_custkey AS k, 'texts/' || c_custkey AS path, CASE WHEN c_custkey % 2 = 0 THEN 'Index:' || c_name ELSE c_name END AS title FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 4 <> 1 AND c_custkey % 6 <> 0)
SELECT DISTINCT unnest([CAST(k AS VARCHAR), title, regexp_replace(title, '^[^:]*:', '')]) AS key, path FROM f
""")
def text_index_keys(t: Tables):
    path = f"{shared_dir(t.spark)}/indexes/{t.spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    key = F.col("c_custkey")
    title = F.when(key % 2 == 0, F.concat(F.lit("Index:"), "c_name")).otherwise(F.col("c_name"))
    row = F.to_json(F.struct(F.when(key % 4 == 1, "page").when(key % 2 == 0, "index").otherwise("main").alias("ns"), F.when(key % 6 != 0, key).alias("pageid"), F.concat(F.lit("texts/"), key).alias("path"), title.alias("title")))
    # some lines are blank, and some are no JSON
    t.customer.select(F.when(key % 22 == 0, "").when(key % 11 == 0, '{"ns": "main", "pageid": ').otherwise(row).alias("value")).write.text(path)
    files = t.customer.select(F.concat(F.lit("texts/"), key).alias("path"))
    return tables.text_keys(tables.read_text_index(t.spark, path), files)
