"""Finding titles, and trees cut to what matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import closure

LEAST_LETTERS = 3


def matches(title: Column, query: str, exact: bool = False) -> Column:
    """Whether a title, lower-cased, has the query in it or is it. A query of fewer than LEAST_LETTERS letters matches nothing unless exact."""
    q = query.strip().lower()
    if exact:
        return F.lower(title) == q
    return F.lower(title).contains(q) if len(q) >= LEAST_LETTERS else F.lit(False)


def filtered_tree(edges: DataFrame, hits: DataFrame) -> DataFrame:
    """(node) of the nodes to show: hits and all above them. Walks up from the hits only."""
    up = edges.select(F.col("child").alias("parent"), F.col("parent").alias("child"))
    return closure(up, hits).select("node").distinct()


def multi_filed(filings: DataFrame) -> DataFrame:
    """(item, n, places) of items filed in several places."""
    return filings.groupBy("item").agg(F.count_distinct("place").alias("n"), F.array_sort(F.collect_set("place")).alias("places")).where("n > 1")


def siblings(filings: DataFrame) -> DataFrame:
    """(place, item, other): other places of an item that is filed in several. An item's filings are few; pairs are of places, not of items."""
    several = filings.groupBy("item").agg(F.collect_set("place").alias("places")).where("size(places) > 1")
    return several.select("item", F.explode("places").alias("place"), "places").select("place", "item", F.explode(F.array_except("places", F.array("place"))).alias("other"))


def capped(rows: DataFrame, group: str, order: list[str], k: int = 300) -> DataFrame:
    """The first k rows of each group, for display."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rank") <= k)


def breadcrumbs(tree: DataFrame, hits: DataFrame) -> DataFrame:
    """(node, path): the way from the top of a forest (node, parent) to each hit, tops first. Walks up a level a round."""
    from ..staging import staged

    tree = staged(tree.select("node", "parent"))
    open_ = staged(hits.select("node", F.array("node").alias("path"), F.col("node").alias("at")))
    done = None
    while not open_.isEmpty():
        met = staged(open_.join(tree.select(F.col("node").alias("at"), "parent"), "at", "left"))
        stop = F.col("parent").isNull() | F.array_contains("path", F.col("parent"))
        ended = met.where(stop).select("node", "path")
        done = ended if done is None else done.unionByName(ended)
        open_ = staged(met.where(~stop).select("node", F.concat(F.array("parent"), "path").alias("path"), F.col("parent").alias("at")))
    return done if done is not None else open_.select("node", "path")
