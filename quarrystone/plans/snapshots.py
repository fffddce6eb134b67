"""As-of states, changes between them, trends and logs on orders and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import checks, diff, rollup, snapshot
from ..sources import tables
from .registry import Tables, query

_OLD, _NEW = "1998-01-01", "1999-01-01"


def _rosters(t: Tables):
    """Customers as of two dates: by their newest order, orphaned where it is pending, with the priorities of all orders so far."""

    def one(day: str):
        past = t.orders.where(F.col("o_orderdate") <= F.to_timestamp(F.lit(day)))
        filings = past.select(
            F.col("o_custkey").alias("item"), F.col("o_orderpriority").alias("category"), (F.col("o_orderstatus") == "P").alias("orphaned"), F.round("o_totalprice").cast("bigint").alias("bytes"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("last_changed")
        )
        return diff.roster(filings)

    return one(_OLD), one(_NEW)


_ROSTER_SQL = """
roster AS (SELECT d.day, o_custkey AS item, list_sort(list(DISTINCT o_orderpriority)) AS categories, bool_and(o_orderstatus = 'P') AS orphaned,
    max(CAST(round(o_totalprice) AS BIGINT)) AS bytes, max(strftime(o_orderdate, '%Y-%m-%d')) AS last_changed
  FROM orders, (SELECT unnest([DATE '1998-01-01', DATE '1999-01-01']) AS day) d WHERE o_orderdate <= d.day GROUP BY ALL),
a AS (SELECT * FROM roster WHERE day = DATE '1998-01-01'), b AS (SELECT * FROM roster WHERE day = DATE '1999-01-01'),
diff AS (SELECT coalesce(a.item, b.item) AS item,
  CASE WHEN a.item IS NULL THEN 'added' WHEN b.item IS NULL THEN 'removed' WHEN a.orphaned AND NOT b.orphaned THEN 'categorized'
    WHEN NOT a.orphaned AND b.orphaned THEN 'orphaned' WHEN NOT a.orphaned AND NOT b.orphaned AND a.categories <> b.categories THEN 'recategorized' ELSE 'unchanged' END AS kind,
  coalesce(NOT a.orphaned AND NOT b.orphaned AND a.last_changed <> b.last_changed, false) AS changed,
  coalesce(a.bytes, 0) AS old_bytes, coalesce(b.bytes, 0) AS new_bytes FROM a FULL JOIN b ON a.item = b.item)"""


@query("""
WITH c AS (SELECT unnest(generate_series(TIMESTAMP '1996-01-01', TIMESTAMP '2000-01-01', INTERVAL 6 MONTH)) AS cutoff)
SELECT strftime(cutoff, '%Y-%m-%d') AS cutoff, o_custkey, o_orderkey, o_orderstatus FROM c, orders WHERE o_orderdate <= cutoff AND o_orderstatus <> 'P'
QUALIFY row_number() OVER (PARTITION BY cutoff, o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def asof_snapshot(t: Tables):
    cutoffs = t.spark.range(1).select(F.explode(F.sequence(F.to_timestamp(F.lit("1996-01-01")), F.to_timestamp(F.lit("2000-01-01")), F.expr("interval 6 months"))).alias("cutoff"))
    history = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"), (F.col("o_orderstatus") != "P").alias("visible"))
    out = snapshot.as_of(history, cutoffs, "o_custkey", "o_orderdate", "o_orderkey", "visible")
    return out.select(F.date_format("cutoff", "yyyy-MM-dd").alias("cutoff"), "o_custkey", "o_orderkey", "o_orderstatus")


@query(f"WITH {_ROSTER_SQL} SELECT * FROM diff")
def snapshot_diff_class(t: Tables):
    return diff.classified(*_rosters(t))


@query(f"""
WITH {_ROSTER_SQL}, k AS (SELECT kind FROM diff WHERE kind <> 'unchanged' UNION ALL SELECT 'changed' FROM diff WHERE changed)
SELECT kind, CAST(count(*) AS BIGINT) AS n, round(100.0 * count(*) / (SELECT count(*) FROM a), 6) AS percent FROM k GROUP BY kind
""")
def change_counts(t: Tables):
    old, new = _rosters(t)
    total = old.agg(F.count(F.lit(1)).alias("__n"))
    changes = diff.classified(old, new)
    return diff.change_counts(changes, F.lit(None).cast("bigint")).drop("percent").crossJoin(F.broadcast(total)).select("kind", "n", F.round(X.percent_change(F.col("n"), F.col("__n")), 6).alias("percent"))


@query("""
WITH s AS (SELECT o_orderdate < TIMESTAMP '1998-01-01' AS early, CAST(count(*) AS BIGINT) AS orders, CAST(count(DISTINCT o_custkey) AS BIGINT) AS customers, CAST(0 AS BIGINT) AS nothing FROM orders GROUP BY 1),
l AS (SELECT early, unnest(['orders', 'customers', 'nothing']) AS metric, unnest([orders, customers, nothing]) AS v FROM s)
SELECT a.metric, a.v AS old, b.v AS new, b.v - a.v AS delta, round(100.0 * (b.v - a.v) / nullif(a.v, 0), 6) AS percent FROM l a JOIN l b ON a.metric = b.metric AND a.early AND NOT b.early
""")
def diff_report(t: Tables):
    def stats(late: bool):
        day = F.to_timestamp(F.lit("1998-01-01"))
        own = t.orders.where(F.col("o_orderdate") >= day if late else F.col("o_orderdate") < day)
        return own.agg(F.count(F.lit(1)).alias("orders"), F.count_distinct("o_custkey").alias("customers"), F.lit(0).alias("nothing"))

    return diff.stats_report(stats(False), stats(True), ["orders", "customers", "nothing"]).withColumn("percent", F.round("percent", 6))


@query("""
WITH e AS (SELECT o_custkey AS item, date_trunc('month', o_orderdate) AS m, bool_or(o_orderstatus = 'F') AS add, bool_or(o_orderstatus = 'O') AS del, max(CAST(round(o_totalprice) AS BIGINT)) AS v
  FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL),
q AS (SELECT item, m, add, del, v, quarter(m) + 4 * (year(m) - 1995) - 1 AS g FROM e),
f AS (SELECT *, coalesce(lag(add AND NOT del) OVER w, false) AS was_added, row_number() OVER (PARTITION BY g, item ORDER BY m DESC) AS k FROM q WINDOW w AS (PARTITION BY g, item ORDER BY m))
SELECT CAST(g AS BIGINT) AS "group", item, CASE WHEN del THEN 'removed' ELSE 'added' END AS status, v AS bytes FROM f WHERE k = 1 AND NOT (del AND (add OR was_added))
""")
def net_changes_quarterly(t: Tables):
    """Additions and removals of customers by month, netted by quarter; within a month the addition comes first, and a removal right after one undoes it."""
    return _netted_by_quarter(t.orders)


def _netted_by_quarter(orders):
    own = orders.where("o_orderstatus <> 'P'")
    month = F.date_trunc("month", "o_orderdate")
    both = own.groupBy(F.col("o_custkey").alias("item"), month.alias("m")).agg(F.bool_or(F.col("o_orderstatus") == "F").alias("add"), F.bool_or(F.col("o_orderstatus") == "O").alias("del"), F.max(F.round("o_totalprice").cast("bigint")).alias("v"))
    kinds = F.array_compact(F.array(F.when(F.col("add"), F.lit("added")), F.when(F.col("del"), F.lit("removed"))))
    none = F.lit(None).cast("string")
    events = both.select(
        F.date_format("m", "yyyy-MM").alias("month"), "item", F.explode(kinds).alias("kind"), F.col("v").alias("old_bytes"), F.col("v").alias("new_bytes"), none.alias("date"), none.alias("from"), none.alias("to"), none.alias("old"), none.alias("new"), (F.quarter("m") + 4 * (F.year("m") - 1995) - 1).cast("bigint").alias("g")
    )
    return diff.netted(events, F.col("g")).select("group", "item", "status", "bytes")


@query("""
WITH r AS (SELECT strftime(ts, '%Y-%m') AS month, count(*) AS revisions, count(*) FILTER (event_type <> 'error') AS main_revisions FROM events GROUP BY 1),
f AS (SELECT strftime(first, '%Y-%m') AS month, count(*) AS new_pages FROM (SELECT user_id, min(ts) AS first FROM events WHERE event_type <> 'error' GROUP BY 1) GROUP BY 1)
SELECT coalesce(r.month, f.month) AS month, CAST(coalesce(revisions, 0) AS BIGINT) AS revisions, CAST(coalesce(main_revisions, 0) AS BIGINT) AS main_revisions, CAST(coalesce(new_pages, 0) AS BIGINT) AS new_pages
FROM r FULL JOIN f ON r.month = f.month
""")
def month_histogram(t: Tables):
    return snapshot.month_histogram(t.events, "user_id", "ts", F.col("event_type") != "error")


@query("""
WITH w(name, lo, hi) AS (VALUES ('first', TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-08'), ('second', TIMESTAMP '2024-01-08', TIMESTAMP '2024-01-20')),
c AS (SELECT name, user_id AS value, count(*) AS n FROM events JOIN w ON ts >= lo AND ts < hi GROUP BY ALL)
SELECT name, value, CAST(n AS BIGINT) AS n, CAST(row_number() OVER (PARTITION BY name ORDER BY n DESC, value) AS INTEGER) AS rank FROM c QUALIFY rank <= 6
""")
def burst_topk(t: Tables):
    windows = t.spark.sql("SELECT * FROM VALUES ('first', TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-08'), ('second', TIMESTAMP '2024-01-08', TIMESTAMP '2024-01-20') AS w(name, lo, hi)")
    return snapshot.top_by_window(t.events.withColumn("ts", F.col("ts").cast("timestamp")), windows, "ts", "user_id", 6)


@query("""
SELECT event_id, ts, user_id FROM events ORDER BY ts, event_id LIMIT 40
""")
def earliest_events(t: Tables):
    return t.events.select("event_id", "ts", "user_id").orderBy("ts", "event_id").limit(40)


def _monthly(t: Tables):
    """A log of entries, one a month, with the value before and after; every ninth is left out."""
    from pyspark.sql import Window

    months = t.orders.groupBy(F.trunc("o_orderdate", "month").alias("date")).agg(F.count(F.lit(1)).alias("new"))
    order = Window.orderBy("date")
    log = months.select("date", F.lag("date").over(order).alias("old_date"), F.lag("new").over(order).alias("old"), "new", F.row_number().over(order).alias("id")).where("old is not null")
    return log.where("id % 9 <> 0")


_MONTHLY_SQL = """
m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, CAST(count(*) AS BIGINT) AS new FROM orders GROUP BY 1),
log AS (SELECT * FROM (SELECT date, lag(date) OVER (ORDER BY date) AS old_date, lag(new) OVER (ORDER BY date) AS old, new, row_number() OVER (ORDER BY date) AS id FROM m) WHERE old IS NOT NULL AND id % 9 <> 0)"""


@query(f"WITH {_MONTHLY_SQL} SELECT date, old_date, previous FROM (SELECT date, old_date, lag(date) OVER (ORDER BY date) AS previous FROM log) WHERE previous <> old_date")
def chain_continuity(t: Tables):
    return checks.broken_chain(_monthly(t)).select("date", "old_date", "previous")


@query(f"""
WITH {_MONTHLY_SQL}, g AS (SELECT date, year(date) * 12 + month(date) - row_number() OVER (ORDER BY date) AS island FROM log)
SELECT min(date) AS first, max(date) AS last, CAST(count(*) AS BIGINT) AS n FROM g GROUP BY island
""")
def month_gaps(t: Tables):
    return checks.month_gaps(_monthly(t), "date")


@query(f"WITH {_MONTHLY_SQL} SELECT old_date AS date, old AS value FROM log WHERE date = (SELECT min(date) FROM log) UNION ALL SELECT date, new FROM log")
def trend_points(t: Tables):
    return diff.trend_points(_monthly(t))


@query(f"""
WITH {_MONTHLY_SQL}, g AS (SELECT *, CAST(floor((row_number() OVER (ORDER BY date DESC) - 1) / 3) AS BIGINT) AS grp FROM log)
SELECT grp, min(old_date) AS old_date, max(date) AS date, arg_min(old, date) AS old, arg_max(new, date) AS new, CAST(count(*) AS BIGINT) AS n FROM g GROUP BY grp
""")
def grouped_entries(t: Tables):
    """Three months an entry, counted from the newest."""
    grouped = _monthly(t).withColumn("grp", diff.newest_groups(F.col("date"), 3).cast("bigint"))
    return grouped.groupBy("grp").agg(F.min("old_date").alias("old_date"), F.max("date").alias("date"), F.min_by("old", "date").alias("old"), F.max_by("new", "date").alias("new"), F.count(F.lit(1)).alias("n"))


@query(f"WITH {_MONTHLY_SQL} SELECT date, new, new - lag(new) OVER (ORDER BY date) AS delta FROM log")
def month_deltas(t: Tables):
    from pyspark.sql import Window

    return _monthly(t).select("date", "new", (F.col("new") - F.lag("new").over(Window.orderBy("date"))).alias("delta"))


@query(f"""
WITH {_MONTHLY_SQL}, more AS (SELECT * FROM m WHERE false),
fresh AS (SELECT date, old_date, old + 1 AS old, new + 1 AS new FROM log WHERE id % 10 = 0
  UNION ALL SELECT DATE '2030-01-01', DATE '2029-12-01', 1, 2)
SELECT l.date, l.old_date, coalesce(f.old, l.old) AS old, coalesce(f.new, l.new) AS new, CAST(l.id AS INTEGER) AS id FROM log l LEFT JOIN fresh f USING (date, old_date)
UNION ALL SELECT date, old_date, old, new, CAST((SELECT max(id) FROM log) + 1 AS INTEGER) FROM fresh WHERE date = DATE '2030-01-01'
""")
def log_upsert(t: Tables):
    log = _monthly(t)
    changed = log.where("id % 10 = 0").select("date", "old_date", (F.col("old") + 1).alias("old"), (F.col("new") + 1).alias("new"))
    extra = t.spark.range(1).select(F.to_date(F.lit("2030-01-01")).alias("date"), F.to_date(F.lit("2029-12-01")).alias("old_date"), F.lit(1).cast("bigint").alias("old"), F.lit(2).cast("bigint").alias("new"))
    return diff.upserted(log, changed.unionByName(extra))


@query("""
WITH p AS (SELECT DISTINCT CAST(month(o_orderdate) AS INTEGER) * 10 AS x FROM orders), q AS (SELECT unnest([0, 14, 15, 16, 55, 500]) AS pos)
SELECT CAST(pos AS INTEGER) AS pos, arg_min(x, abs(x - pos) * 1000 + x) AS nearest FROM q, p GROUP BY pos
""")
def nearest_points(t: Tables):
    points = t.orders.select((F.month("o_orderdate") * 10).alias("x")).distinct()
    return diff.nearest(points, t.spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in (0, 14, 15, 16, 55, 500)])).alias("pos")), at="pos")


@query("""
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m') AS month, min(o_orderdate) AS date FROM orders GROUP BY 1
""")
def one_per_month(t: Tables):
    return tables.one_per_month(t.orders.select(F.col("o_orderdate").alias("date")))


@query("""
SELECT o_custkey AS month, o_orderkey, o_orderpriority AS priority FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey) = 1
""")
def preferred_source(t: Tables):
    rows = t.orders.select(F.col("o_custkey").alias("month"), "o_orderkey", F.struct("o_orderpriority", "o_orderkey").alias("rank"), F.col("o_orderpriority").alias("priority"))
    return tables.preferred(rows, "month", "rank").drop("rank")


@query("""
SELECT CAST(unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS DATE) AS cutoff FROM orders
""")
def month_cutoffs(t: Tables):
    return t.orders.agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")).select(snapshot.month_cutoffs(F.to_date("a"), F.to_date("b")))


@query("""
SELECT CAST(c_nationkey AS BIGINT) AS title, CAST(sum(CAST(round(c_acctbal) AS BIGINT)) AS BIGINT) AS raw_bytes, CAST(count(*) AS BIGINT) AS content_bytes, coalesce(max(nullif(CASE WHEN c_custkey % 2 = 0 THEN '' ELSE c_mktsegment END, '')), '') AS last_changed
FROM customer GROUP BY c_nationkey
""")
def stats_monoid(t: Tables):
    own = t.customer.select(F.col("c_nationkey").cast("bigint").alias("title"), F.round("c_acctbal").cast("bigint").alias("raw_bytes"), F.lit(1).alias("content_bytes"), F.expr("if(c_custkey % 2 = 0, '', c_mktsegment)").alias("last_changed"))
    return own.groupBy("title").agg(*rollup.merged(stats=("raw_bytes", "content_bytes")))


@query("""
WITH e AS (SELECT o_orderpriority AS era, min(o_orderdate) + to_months(CAST(substr(o_orderpriority, 1, 1) AS INTEGER)) AS first, max(o_orderdate) AS last FROM orders GROUP BY 1),
m AS (SELECT era, first, CAST((year(last) - year(first)) * 12 + month(last) - month(first) + 1 AS INTEGER) AS months FROM e)
SELECT era, months, round(100.0 * months / sum(months) OVER (), 6) AS percent, round(100.0 * (sum(months) OVER (ORDER BY first) - months) / sum(months) OVER (), 6) AS start_percent FROM m
""")
def timeline(t: Tables):
    """Priorities as eras, each beginning some months later."""
    eras = t.orders.groupBy(F.col("o_orderpriority").alias("era")).agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    eras = eras.withColumn("first", F.expr("first + make_ym_interval(0, cast(substr(era, 1, 1) as int))"))
    return diff.timeline(eras).withColumns({"percent": F.round("percent", 6), "start_percent": F.round("start_percent", 6)})


@query("""
SELECT 'dump-*-' || (o_custkey % 5) || '.xml' AS stem, max('dump-' || strftime(o_orderdate, '%Y-%m-%d') || '-' || (o_custkey % 5) || '.xml') AS name FROM orders GROUP BY o_custkey % 5
""")
def newest_names(t: Tables):
    return tables.newest_names(t.orders.select(F.concat(F.lit("dump-"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("-"), (F.col("o_custkey") % 5).cast("string"), F.lit(".xml")).alias("name")))
