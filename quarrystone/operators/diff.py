"""Changes between snapshots, and their net effect over several."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import percent_change


def roster(filings: DataFrame) -> DataFrame:
    """Per item of filings (item, category, orphaned, bytes, last_changed): its categories in order, orphaned if every filing is, and the statistics."""
    return filings.groupBy("item").agg(F.array_sort(F.collect_set("category")).alias("categories"), F.bool_and("orphaned").alias("orphaned"), F.max("bytes").alias("bytes"), F.max("last_changed").alias("last_changed"))


def classified(old: DataFrame, new: DataFrame) -> DataFrame:
    """(item, kind, changed, old_bytes, new_bytes) of every item in either roster.

    kind: added, removed, categorized, orphaned, recategorized or unchanged. changed: central in both with different non-empty times.
    """
    a, b = (r.select("item", *[F.col(c).alias(f"{p}_{c}") for c in ("categories", "orphaned", "bytes", "last_changed")], F.lit(True).alias(f"in_{p}")) for r, p in ((old, "old"), (new, "new")))
    both = a.join(b, "item", "full_outer")
    kind = (
        F.when(F.col("in_old").isNull(), "added")
        .when(F.col("in_new").isNull(), "removed")
        .when(F.col("old_orphaned") & ~F.col("new_orphaned"), "categorized")
        .when(~F.col("old_orphaned") & F.col("new_orphaned"), "orphaned")
        .when(~F.col("old_orphaned") & ~F.col("new_orphaned") & (F.col("old_categories") != F.col("new_categories")), "recategorized")
        .otherwise("unchanged")
    )
    moved = ~F.col("old_orphaned") & ~F.col("new_orphaned") & (F.col("old_last_changed") != "") & (F.col("new_last_changed") != "") & (F.col("old_last_changed") != F.col("new_last_changed"))
    return both.select("item", kind.alias("kind"), F.coalesce(moved, F.lit(False)).alias("changed"), F.coalesce("old_bytes", F.lit(0)).alias("old_bytes"), F.coalesce("new_bytes", F.lit(0)).alias("new_bytes"))


def change_counts(changes: DataFrame, old_count: Column) -> DataFrame:
    """(kind, n, percent of old_count)."""
    every = changes.select("kind").where("kind <> 'unchanged'").unionByName(changes.where("changed").select(F.lit("changed").alias("kind")))
    return every.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).withColumn("percent", percent_change(F.col("n"), old_count))


def stats_report(old: DataFrame, new: DataFrame, columns: list[str]) -> DataFrame:
    """(metric, old, new, delta, percent) of two one-row tables; null if the base is 0."""
    long = lambda df, name: df.select(F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in columns]), F.array(*[F.coalesce(c, F.lit(0)).cast("bigint") for c in columns]))).alias("metric", name))
    delta = F.col("new") - F.col("old")
    return long(old, "old").join(long(new, "new"), "metric").select("metric", "old", "new", delta.alias("delta"), percent_change(delta, F.col("old")).alias("percent"))


def full_report(old: DataFrame, new: DataFrame, columns: list[str]) -> DataFrame:
    """(section, metric, old, new, delta, percent) of two snapshots, one row each with structs `root` and `all`: central is the root's
    figures, all those with the orphans, or the root's where a snapshot has none."""
    part = lambda df, name: df.select(F.coalesce(F.col("all"), F.col("root")).alias("s") if name == "all" else F.col("root").alias("s")).select("s.*")
    sections = [stats_report(part(old, name), part(new, name), columns).select(F.lit(name).alias("section"), "*") for name in ("central", "all")]
    return sections[0].unionByName(sections[1])


def reconstruction_error(real: DataFrame, rebuilt: DataFrame, stats: tuple[DataFrame, DataFrame], columns: list[str]) -> DataFrame:
    """(what, real, rebuilt, percent) of a rebuilt snapshot against the real one: metrics by `stats` (of each, one row), and how many items of the rosters are of each kind of change."""
    metrics = stats_report(*stats, columns).select(F.col("metric").alias("what"), F.col("old").alias("real"), F.col("new").alias("rebuilt"), "percent")
    total = real.agg(F.count(F.lit(1)).alias("real"))
    kinds = classified(real, rebuilt).where("kind <> 'unchanged'").groupBy(F.concat(F.lit("items "), "kind").alias("what")).agg(F.count(F.lit(1)).alias("rebuilt"))
    return metrics.unionByName(kinds.crossJoin(F.broadcast(total)).select("what", "real", "rebuilt", percent_change(F.col("rebuilt"), F.col("real")).alias("percent")))  # one row


#: Order of events within a month.
EVENTS = ("added", "removed", "categorized", "orphaned", "recategorized", "changed")
_FIELDS = ("bytes", "date", "from", "to", "old", "new", "old_bytes", "new_bytes")
_STATE = "struct<status string, bytes bigint, date string, `from` string, `to` string, old string, new string, old_bytes bigint, new_bytes bigint>"


def netted(events: DataFrame, group: Column | None = None) -> DataFrame:
    """Net effect per group and item of events (month, item, kind, old_bytes, new_bytes, date, from, to, old, new).

    Events of an item are folded in order of month and of EVENTS inside the JVM; one item's history is what
    meets in a row. Items without a net effect are left out.
    """
    ord_ = F.array_position(F.array(*[F.lit(e) for e in EVENTS]), F.col("kind"))
    event = F.struct("month", ord_.alias("ord"), "kind", "old_bytes", "new_bytes", "date", "from", "to", "old", "new")
    keyed = events.select((F.lit(0) if group is None else group).alias("group"), "item", event.alias("e"))
    folded = keyed.groupBy("group", "item").agg(F.sort_array(F.collect_list("e")).alias("es"))
    state = F.aggregate("es", F.lit(None).cast(_STATE), _step)
    return folded.select("group", "item", state.alias("s")).where("s is not null").select("group", "item", "s.status", *[f"s.`{c}`" for c in _FIELDS])


def _state(status, **fields) -> Column:
    kinds = {"bytes": "bigint", "old_bytes": "bigint", "new_bytes": "bigint"}
    parts = [(status if isinstance(status, Column) else F.lit(status)).alias("status")]
    return F.struct(*parts, *[(fields[c] if c in fields else F.lit(None)).cast(kinds.get(c, "string")).alias(c) for c in _FIELDS]).cast(_STATE)


def _step(s: Column, e: Column) -> Column:
    none = F.lit(None).cast(_STATE)
    was = F.coalesce(s["status"], F.lit(""))
    kept = {c: s[c] for c in _FIELDS}
    added = _state("added", bytes=e["new_bytes"], date=e["date"])
    removed = F.when(was == "added", none).otherwise(_state("removed", bytes=e["old_bytes"]))
    categorized = (
        F.when(was == "added", added).when(was == "orphaned", none).otherwise(_state("categorized", bytes=e["new_bytes"], date=e["date"], to=e["to"], **{"from": F.when(was == "categorized", s["from"]).otherwise(e["from"])}))
    )
    orphaned = F.when(was == "added", _state("added", bytes=e["old_bytes"], date=s["date"])).when(was == "categorized", none).otherwise(_state("orphaned", bytes=e["old_bytes"], **{"from": e["from"]}))
    recategorized = F.when(was.isin("added", "categorized", "orphaned"), s).otherwise(_state("recategorized", bytes=e["new_bytes"], to=e["to"], **{"from": F.when(was == "recategorized", s["from"]).otherwise(e["from"])}))
    again = was == "changed"
    changed = (
        F.when(was == "added", _state("added", bytes=e["new_bytes"], date=e["new"]))
        .when((was != "") & ~again, _state(s["status"], **{**kept, "bytes": e["new_bytes"]}))
        .otherwise(_state("changed", old=F.when(again, s["old"]).otherwise(e["old"]), new=e["new"], old_bytes=F.when(again, s["old_bytes"]).otherwise(e["old_bytes"]), new_bytes=e["new_bytes"]))
    )
    kind = e["kind"]
    return F.when(kind == "added", added).when(kind == "removed", removed).when(kind == "categorized", categorized).when(kind == "orphaned", orphaned).when(kind == "recategorized", recategorized).otherwise(changed)


def newest_groups(order: Column, size: int) -> Column:
    """Number of a row's group of `size`, counted back from the newest, so that a part group is the oldest. For tables of dates, which are short."""
    return F.floor((F.row_number().over(Window.orderBy(order.desc())) - 1) / size)


def upserted(log: DataFrame, entries: DataFrame, key: tuple[str, ...] = ("old_date", "date")) -> DataFrame:
    """The log with entries added or put in place of those with the same key; ids stay, new ones go on from the largest."""
    old = log.select(*key, "id")
    new = entries.join(old, list(key), "left")
    largest = log.agg(F.coalesce(F.max("id"), F.lit(0)).alias("__largest"))
    fresh = new.where("id is null").drop("id").crossJoin(F.broadcast(largest)).withColumn("id", (F.col("__largest") + F.row_number().over(Window.orderBy(*key))).cast(log.schema["id"].dataType)).drop("__largest")
    kept = log.join(entries.select(*key), list(key), "left_anti")
    return kept.unionByName(new.where("id is not null").select(*log.columns)).unionByName(fresh.select(*log.columns))


def trend_points(log: DataFrame, date: str = "date", old_date: str = "old_date", old: str = "old", new: str = "new") -> DataFrame:
    """(date, value) of a chain of entries: the first one's old value, then each one's new value."""
    first = log.agg(F.min_by(F.struct(F.col(old_date).alias("date"), F.col(old).alias("value")), date).alias("p")).select("p.date", "p.value")
    return first.unionByName(log.select(F.col(date).alias("date"), F.col(new).alias("value")))


def nearest(points: DataFrame, queries: DataFrame, x: str = "x", at: str = "at") -> DataFrame:
    """Per query position `at`: the nearest point's x, the lower one of two. Both sides are lists of a chart, sorted once together."""
    both = points.select(F.col(x).alias("__at"), F.col(x).alias("__x"), F.lit(None).cast(queries.schema[at].dataType).alias(at)).unionByName(queries.select(F.col(at).alias("__at"), F.lit(None).cast(points.schema[x].dataType).alias("__x"), at).distinct())
    order = Window.orderBy("__at")
    low = F.last("__x", ignorenulls=True).over(order.rangeBetween(Window.unboundedPreceding, 0))
    high = F.first("__x", ignorenulls=True).over(order.rangeBetween(0, Window.unboundedFollowing))
    found = both.withColumns({"__low": low, "__high": high}).where(F.col(at).isNotNull())
    return found.select(at, F.when(F.col("__low").isNull() | (F.col("__high") - F.col(at) < F.col(at) - F.col("__low")), F.col("__high")).otherwise(F.col("__low")).alias("nearest"))


def timeline(eras: DataFrame) -> DataFrame:
    """(era, months, percent, start_percent) of eras (era, first, last) in order of their first month: how far each goes on a line of all months. Eras are few."""
    from ..functions.text import months_between

    months = eras.withColumn("months", months_between(F.col("first"), F.col("last")))
    share = F.lit(100.0) / F.sum("months").over(Window.partitionBy(F.lit(1)))
    before = F.coalesce(F.sum("months").over(Window.partitionBy(F.lit(1)).orderBy("first").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return months.select("era", "months", (F.col("months") * share).alias("percent"), (before * share).alias("start_percent"))
