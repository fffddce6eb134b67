"""Statistics along hierarchies, each item counted once, and the tree's rules of display."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import staged
from .graph import closure

STATS = ("raw_bytes", "content_bytes", "transliterated_bytes", "count", "text_count")


def merged(prefix: str = "", stats: tuple[str, ...] = STATS, changed: str | None = "last_changed") -> list:
    """Aggregates that add statistics: sums, and the latest non-empty time ('' if none)."""
    out = [F.coalesce(F.sum(prefix + c), F.lit(0)).alias(c) for c in stats]
    return out + ([F.coalesce(F.max(F.nullif(F.col(prefix + changed), F.lit(""))), F.lit("")).alias(changed)] if changed else [])


def distinct_rollup(reach: DataFrame, filings: DataFrame, items: DataFrame, stats: tuple[str, ...] = STATS, changed: str | None = "last_changed") -> DataFrame:
    """Per ancestor: statistics of the distinct items filed under any node that it reaches.

    reach: ancestor, node. filings: node, item. items: item and statistics. An ancestor of everything has all
    items, but pairs are made distinct and summed in partial aggregates, so that its rows do not meet in one task.
    """
    pairs = reach.join(filings, "node").select("ancestor", "item").distinct()
    return pairs.join(items, "item").groupBy("ancestor").agg(*merged(stats=stats, changed=changed))


def page_rollup(tree: DataFrame, items: DataFrame, stats: tuple[str, ...] = STATS, changed: str | None = "last_changed") -> DataFrame:
    """Per page: statistics of its subtree in a forest (title, parent)."""
    roots = tree.select(F.col("title").alias("node")).distinct()
    reach = closure(tree.where("parent is not null").select("parent", F.col("title").alias("child")), roots)
    return reach.join(items.withColumnRenamed("item", "node"), "node").groupBy(F.col("ancestor").alias("title")).agg(*merged(stats=stats, changed=changed))


def text_counts(items: DataFrame, tree: DataFrame) -> DataFrame:
    """Items with text_count 1 for pages without a parent, else 0."""
    tops = tree.select(F.col("title").alias("item"), F.col("parent").isNull().cast("int").alias("text_count"))
    return items.drop("text_count").join(tops, "item", "left").withColumn("text_count", F.coalesce("text_count", F.lit(0)))


def judged_filings(filings: DataFrame, tags: DataFrame, tree: DataFrame, tops: DataFrame, central: DataFrame) -> DataFrame:
    """Filings (category, title) and `kept`: of a page with a parent it is kept only if neither the parent has the tag nor the top of its work any central one.

    tags: title, category (unfiltered). tree: title, parent. tops: title, top. central: node.
    """
    parents = tree.where("parent is not null").select("title", "parent")
    same = parents.join(tags.select(F.col("title").alias("parent"), "category").distinct(), "parent").select("title", "category", F.lit(True).alias("same"))
    held = tags.join(central.select(F.col("node").alias("category")), "category", "left_semi").select(F.col("title").alias("top"), F.lit(True).alias("held")).distinct()
    out = filings.join(parents, "title", "left").join(same, ["title", "category"], "left").join(tops, "title", "left").join(held, "top", "left")
    kept = F.col("parent").isNull() | ~(F.coalesce("same", F.lit(False)) | F.coalesce("held", F.lit(False)))
    return out.select("category", "title", kept.alias("kept"))


def pruned(edges: DataFrame, filings: DataFrame) -> DataFrame:
    """Categories that suppression has emptied: some filing suppressed, none kept, and every child pruned. Grows to a fixpoint from the leaves."""
    state = filings.groupBy("category").agg(F.max((~F.col("kept")).cast("int")).alias("suppressed"), F.max(F.col("kept").cast("int")).alias("has_kept"))
    able = staged(state.where("suppressed = 1 and has_kept = 0").select(F.col("category").alias("node")))
    edges = staged(edges.select("parent", "child").distinct())
    out = new = staged(able.join(edges.select(F.col("parent").alias("node")), "node", "left_anti"))
    while not new.isEmpty():
        open_ = edges.join(out.select(F.col("node").alias("child")), "child", "left_anti").select(F.col("parent").alias("node"))
        new = staged(able.join(open_, "node", "left_anti").join(out, "node", "left_anti"))
        out = out.unionByName(new)
    return out


def orphans(items: DataFrame, tags: DataFrame, central: DataFrame) -> DataFrame:
    """Items (item) none of whose tags (title, category) is central, with `listed`: whether they have no tag and are listed directly."""
    filed = tags.join(central.select(F.col("node").alias("category")), "category", "left_semi").select(F.col("title").alias("item"))
    tagged = tags.select(F.col("title").alias("item"), F.lit(False).alias("listed")).distinct()
    return items.select("item").distinct().join(filed, "item", "left_anti").join(tagged, "item", "left").select("item", F.coalesce("listed", F.lit(True)).alias("listed"))


def untranscluded_leaves(leaves: DataFrame, used: DataFrame) -> DataFrame:
    """Per index: statistics of its leaves if no page transcludes it; a leaf adds no count. used: index_title."""
    return leaves.join(used.select("index_title").distinct(), "index_title", "left_anti").groupBy("index_title").agg(*merged(stats=STATS[:3]), F.lit(0).cast("bigint").alias("count"))


def index_items(shells: DataFrame, leaves: DataFrame, has_text: DataFrame | None = None) -> DataFrame:
    """Statistics of index items: the shell's own and its leaves'. has_text (index_title): the indexes whose text is known; None is unknown and gives a null text_count."""
    out = shells.join(leaves.select("index_title", *[F.col(c).alias(f"leaf_{c}") for c in STATS[:3]], F.col("last_changed").alias("leaf_changed")), "index_title", "left")
    sums = [(F.col(c) + F.coalesce(f"leaf_{c}", F.lit(0))).alias(c) for c in STATS[:3]]
    changed = F.greatest("last_changed", F.coalesce("leaf_changed", F.lit(""))).alias("last_changed")
    if has_text is None:
        return out.select("index_title", *sums, F.lit(1).cast("bigint").alias("count"), F.lit(None).cast("bigint").alias("text_count"), changed)
    known = has_text.select("index_title", F.lit(1).cast("bigint").alias("text")).distinct()
    return out.join(known, "index_title", "left").select("index_title", *sums, F.lit(1).cast("bigint").alias("count"), F.coalesce("text", F.lit(0)).cast("bigint").alias("text_count"), changed)


def scanned_works(*titles: DataFrame) -> DataFrame:
    """n_works: how many distinct non-empty titles several tables have together."""
    every = titles[0].toDF("title")
    for t in titles[1:]:
        every = every.union(t.toDF("title"))
    return every.where("title <> ''").agg(F.count_distinct("title").alias("n_works"))


def spliced_root(totals: DataFrame, edges: DataFrame, root: str, main: str) -> DataFrame:
    """(scope, statistics): `root`, those of the category `main` if it is a child of the root, else the root's own; `all`, those of everything under the root.

    The two may overlap, so that neither is ever made by adding.
    """
    there = edges.where((F.col("parent") == root) & (F.col("child") == main)).select(F.col("child").alias("ancestor")).distinct()
    top = totals.join(there, "ancestor", "left_semi")
    own = totals.where(F.col("ancestor") == root)
    chosen = top.unionByName(own.withColumn("__own", F.lit(1)).join(there.select(F.lit(1).alias("__own")), "__own", "left_anti").drop("__own"))
    return chosen.withColumn("scope", F.lit("root")).unionByName(own.withColumn("scope", F.lit("all"))).drop("ancestor")


def corpus_stats(pages: DataFrame, tree: DataFrame, categories: DataFrame) -> DataFrame:
    """One row without any category graph: pages, texts (pages without a parent), bytes, and categories that there are. pages: title, redirect_target, raw_bytes."""
    own = pages.where("redirect_target is null").join(tree.select("title", "parent"), "title", "left")
    counted = own.agg(F.count(F.lit(1)).alias("pages"), F.count_if(F.col("parent").isNull()).alias("texts"), F.coalesce(F.sum("raw_bytes"), F.lit(0)).alias("raw_bytes"))
    every = pages.agg(F.count(F.lit(1)).alias("records"))
    return counted.crossJoin(F.broadcast(every)).crossJoin(F.broadcast(categories.agg(F.count_distinct("title").alias("categories"))))  # one row each
