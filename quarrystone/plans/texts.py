"""Text, size and format functions on documents and the relational tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.translit import to_scheme
from ..operators import checks
from ..sources import tables
from .registry import Tables, query


@query("""
SELECT doc_id, CAST(strlen(text) AS BIGINT) AS raw_bytes, CAST(length(text) AS BIGINT) AS chars, CAST(coalesce(nullif(CASE WHEN doc_id % 3 = 0 THEN 0 ELSE strlen(text) END, 0), n_chars) AS BIGINT) AS shown FROM documents
""")
def doc_sizes(t: Tables):
    size = F.octet_length("text").cast("bigint")
    return t.documents.select("doc_id", size.alias("raw_bytes"), F.length("text").cast("bigint").alias("chars"), X.display_bytes(F.when(F.col("doc_id") % 3 == 0, 0).otherwise(size), F.col("n_chars"), size).cast("bigint").alias("shown"))


@query(r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM documents),
f AS (SELECT doc_id, k, line, length(trim(line, ' ' || chr(9) || chr(13))) AS n FROM l),
g AS (SELECT doc_id, k, line, n > 0 AND n < 40 AND NOT regexp_matches(line, '[।॥.!?]') AS nav, n = 0 AS blank FROM f),
-- a run goes from a navigation line on over navigation and blank lines; its last navigation line ends it
h AS (SELECT *, sum(CASE WHEN NOT nav AND NOT blank THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY k) AS part FROM g),
r AS (SELECT doc_id, part, min(k) FILTER (nav) AS lo, max(k) FILTER (nav) AS hi FROM h GROUP BY ALL HAVING count(*) FILTER (nav) >= 5)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (r.lo IS NULL OR k < r.lo OR k > r.hi), '') AS kept FROM h LEFT JOIN r USING (doc_id, part) GROUP BY doc_id
""")
def nav_line_filter(t: Tables):
    return t.documents.select("doc_id", X.strip_nav_lines(F.col("text")).alias("kept"))


@query("""
SELECT p_partkey, '०१२३४५६७८९' AS digits, CAST(p_partkey AS INTEGER) AS n, 'x/' || translate(CAST(p_partkey AS VARCHAR), '0123456789', '०१२३४५६७८९') AS title FROM part
""")
def digit_normalise(t: Tables):
    title = F.concat(F.lit("x/"), X.devanagari_digits(F.col("p_partkey").cast("string")))
    return t.part.select("p_partkey", X.devanagari_digits(F.lit("0123456789")).alias("digits"), X.leaf_number(title).alias("n"), title.alias("title"))


#: SQL of a number of 0 and more to one digit, halves up: printf rounds exact halves, which quarters with an odd numerator are, to even digits.
def _tenths(x: str) -> str:
    return f"printf('%.1f', CASE WHEN {x} * 4 = floor({x} * 4) AND CAST(floor({x} * 4) AS BIGINT) % 2 = 1 THEN {x} + 0.01 ELSE {x} END)"


_SIZE = f"CASE WHEN n / 1e3 < 1000 THEN {_tenths('(n / 1e3)')} || ' KB' ELSE {_tenths('(n / 1e3 / 1e3)')} || ' MB' END"


@query(f"""
WITH o AS (SELECT o_orderkey, CAST(round(o_totalprice) AS BIGINT) AS n, strftime(o_orderdate, '%Y-%m') AS month FROM orders)
SELECT o_orderkey, {_SIZE} AS size, '(' || {_SIZE} || ', ' || (o_orderkey % 3) || CASE WHEN o_orderkey % 3 = 1 THEN ' text' ELSE ' texts' END || ', ' || month || ')' AS label FROM o
""")
def size_labels(t: Tables):
    n = F.round("o_totalprice").cast("bigint")
    return t.orders.select("o_orderkey", X.format_bytes(n).alias("size"), X.stats_label(n, F.col("o_orderkey") % 3, F.lit(None).cast("bigint"), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("label"))


@query(f"""
WITH o AS (SELECT o_orderkey, CAST(round(o_totalprice) AS BIGINT) * 9999 AS n FROM orders)
SELECT o_orderkey, {_tenths('(n / 1e6)')} || ' MB' AS megabytes, CASE WHEN n / 1e6 >= 1000 THEN {_tenths('(n / 1e6 / 1e3)')} || ' GB' ELSE CAST(CAST(floor(n / 1e6 + 0.5) AS BIGINT) AS VARCHAR) || ' MB' END AS axis FROM o
""")
def size_formats(t: Tables):
    n = F.round("o_totalprice").cast("bigint") * 9999
    return t.orders.select("o_orderkey", X.format_megabytes(n).alias("megabytes"), X.axis_bytes(n).alias("axis"))


@query(f"""
WITH s AS (SELECT o_orderkey, o_orderkey % 2000 AS a, o_custkey % 2000 AS b FROM orders),
f AS (SELECT *, abs((b - a) / nullif(a, 0) * 100.0) AS p, CASE WHEN a = 0 THEN '0' WHEN a < 1000 THEN a || ' B' ELSE CAST(CAST(floor(a / 1000.0 + 0.5) AS BIGINT) AS VARCHAR) || ' KB' END AS fa,
  CASE WHEN b = 0 THEN '0' WHEN b < 1000 THEN b || ' B' ELSE CAST(CAST(floor(b / 1000.0 + 0.5) AS BIGINT) AS VARCHAR) || ' KB' END AS fb FROM s)
SELECT o_orderkey, CASE WHEN a = 0 OR b = 0 THEN ' (' || fa || '→' || fb || ')' WHEN fa = fb OR p < 0.1 THEN '' ELSE ' (' || fa || ' → ' || fb || ', ' || CASE WHEN b >= a THEN '↑' ELSE '↓' END || ' ' || {_tenths('p')} || '%)' END AS delta,
  CASE WHEN a = 0 THEN '' ELSE ' (' || CASE WHEN b >= a THEN '↑' ELSE '↓' END || ' ' || {_tenths('p')} || '% from ' || fa || ')' END AS change FROM f
""")
def size_deltas(t: Tables):
    a, b = F.col("o_orderkey") % 2000, F.col("o_custkey") % 2000
    percent = (b - a) / F.nullif(a, F.lit(0)) * F.lit(100.0)
    return t.orders.select("o_orderkey", X.size_delta(a, b).alias("delta"), X.change_text(percent, X.format_bytes_compact(a)).alias("change"))


@query("""
SELECT page_id, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), chr(39), '&#x27;') AS escaped, contains(right(html, 64), '</html>') AS complete FROM pages
""")
def escaped_pages(t: Tables):
    return t.pages.select("page_id", X.html_escape(F.col("html")).alias("escaped"), X.is_complete(F.col("html"), "</html>").alias("complete"))


@query("""
SELECT n_nationkey, 'https://example.org/wiki/' || replace(n_name || '_a/b~%2A%28', ' ', '_') AS url FROM nation
""")
def page_urls(t: Tables):
    return t.nation.select("n_nationkey", X.page_url("https://example.org/wiki/", F.concat("n_name", F.lit(" a/b~*("))).alias("url"))


@query("""
WITH s AS (SELECT p_brand, min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part GROUP BY 1 HAVING min(p_retailprice) < max(p_retailprice)),
r AS (SELECT p_brand, (hi - lo) / 5 AS raw, pow(10.0, floor(log10((hi - lo) / 5))) AS mag FROM s)
SELECT p_brand, round(CASE WHEN raw / mag >= 5 THEN 10.0 WHEN raw / mag >= 2 THEN 5.0 WHEN raw / mag >= 1 THEN 2.0 ELSE 1.0 END * mag, 6) AS step FROM r
""")
def tick_steps(t: Tables):
    ends = t.part.groupBy("p_brand").agg(F.min("p_retailprice").alias("lo"), F.max("p_retailprice").alias("hi")).where("lo < hi")
    return ends.select("p_brand", F.round(X.tick_step(F.col("lo"), F.col("hi"), 5), 6).alias("step"))


@query("""
SELECT doc_id, CAST(strlen(text) AS BIGINT) AS n FROM documents WHERE strlen(text) > n_chars
""")
def oversized(t: Tables):
    return checks.oversized(t.documents.select("doc_id", F.octet_length("text").alias("n"), F.octet_length("text").alias("content_bytes"), F.col("n_chars").alias("raw_bytes"))).select("doc_id", F.col("n").cast("bigint").alias("n"))


@query("""
SELECT field, n FROM (SELECT unnest(['quality', 'toxic']) AS field, unnest([count(*) - count(quality), count(*) - count(toxic)]) AS n FROM (SELECT d.doc_id, quality, toxic FROM documents d LEFT JOIN labels l USING (doc_id))) WHERE n > 0
""")
def missing_fields(t: Tables):
    return checks.missing_fields(t.documents.select("doc_id").join(t.labels, "doc_id", "left"), ["quality", "toxic"])


@query("""
SELECT 'd' || doc_id AS name, 'missing' AS state FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT 'x' || item_id, 'stale' FROM benchmark
""")
def stale_and_missing(t: Tables):
    expected = t.documents.select(F.concat(F.lit("d"), "doc_id").alias("name"))
    actual = t.labels.select(F.concat(F.lit("d"), "doc_id").alias("name")).unionByName(t.benchmark.select(F.concat(F.lit("x"), "item_id").alias("name")))
    return checks.stale_and_missing(expected, actual)


@query("""
SELECT 'f' || doc_id AS name, CASE WHEN doc_id % 5 = 0 THEN 'missing' WHEN doc_id % 5 = 1 THEN 'mismatch' ELSE 'ok' END AS state FROM documents
""")
def verified_files(t: Tables):
    name = F.concat(F.lit("f"), F.col("doc_id"))
    lines = t.documents.select(F.concat(F.sha2("text", 256), F.lit("  "), name).alias("value"))
    files = t.documents.where("doc_id % 5 <> 0").select(name.alias("name"), F.when(F.col("doc_id") % 5 == 1, F.concat("text", F.lit("x"))).otherwise(F.col("text")).cast("binary").alias("content"))
    return tables.verified(tables.parse_manifest(lines), files)


@query("""
SELECT source, CAST(sum(n_chars) AS BIGINT) AS chars, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY source
""")
def text_summary(t: Tables):
    """Pages and sizes by group."""
    return t.documents.groupBy("source").agg(F.sum("n_chars").alias("chars"), F.count(F.lit(1)).alias("n"))


@query("""
SELECT r_regionkey, 'rāmaḥ kṛṣṇaś ca 12' AS iast, 'rAmaH kRSNaz ca 12' AS hk, 'rAmaH kfzRaS ca 12' AS slp1 FROM region
""")
def transliterated(t: Tables):
    s = F.lit("रामः कृष्णश् च १२")
    return t.region.select("r_regionkey", *[to_scheme(s, k).alias(k) for k in ("iast", "hk", "slp1")])


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, CAST(date_trunc('second', ts) AS TIMESTAMP) AS parsed, CAST(ts AS DATE) AS day FROM events
""")
def iso_times(t: Tables):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    day = X.identifier_date(F.concat(F.lit("dump-"), F.date_format("ts", "yyyyMMdd")))
    return t.events.select("event_id", iso.alias("iso"), X.parse_timestamp(iso).cast("timestamp_ntz").alias("parsed"), day.alias("day"))


@query("""
SELECT event_id, CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS BIGINT) AS k FROM events
""")
def json_field(t: Tables):
    return t.events.select("event_id", F.coalesce(F.get_json_object("props", "$.k").cast("bigint"), F.lit(0)).alias("k"))


@query("""
WITH s AS (SELECT p_brand, min(p_size) AS lo, max(p_size) AS hi FROM part GROUP BY 1)
SELECT p_brand, CASE WHEN ceil(lo / 20.0) <= floor(hi / 20.0) THEN CAST(unnest(range(CAST(ceil(lo / 20.0) AS BIGINT), CAST(floor(hi / 20.0) AS BIGINT) + 1)) * 20 AS DOUBLE) ELSE CAST(lo AS DOUBLE) END AS tick FROM s
""")
def fixed_ticks(t: Tables):
    ends = t.part.groupBy("p_brand").agg(F.min("p_size").alias("lo"), F.max("p_size").alias("hi"))
    return ends.select("p_brand", F.explode(X.fixed_ticks(F.col("lo"), F.col("hi"), F.lit(20))).alias("tick"))
