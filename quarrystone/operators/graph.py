"""Digraphs as edge tables (parent, child): closure, cycles, orphans, order of display.

Rounds are joins of what is new only; each round is staged, so that neither lineage nor memory grows
with their number. Closures are true sets of reachable nodes, also on cycles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import staged


def category_edges(pages: DataFrame, title: str = "title", categories: str = "categories") -> DataFrame:
    """Distinct (parent, child) of every category that a page names."""
    return pages.select(F.explode(categories).alias("parent"), F.col(title).alias("child")).distinct()


def closure(edges: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """(ancestor, node) for every node that an ancestor reaches, itself included; of `roots` (column node) only, if given."""
    edges = staged(edges.select("parent", "child").where("parent is not null and child is not null").distinct())
    start = roots.select("node") if roots is not None else edges.select(F.explode(F.array("parent", "child")).alias("node"))
    known = new = staged(start.distinct().select(F.col("node").alias("ancestor"), "node"))
    while not new.isEmpty():
        step = new.join(edges, new["node"] == edges["parent"]).select("ancestor", F.col("child").alias("node")).distinct()
        new = staged(step.join(known, ["ancestor", "node"], "left_anti"))
        known = known.unionByName(new)
    return known


def reachable(edges: DataFrame, root: str) -> DataFrame:
    """The nodes that `root` reaches, itself included."""
    return closure(edges, edges.sparkSession.range(1).select(F.lit(root).alias("node"))).select("node")


def orphan_roots(nodes: DataFrame, edges: DataFrame, root: str | None = None) -> DataFrame:
    """Nodes without a parent, but for the root."""
    out = nodes.select("node").distinct().join(edges.select(F.col("child").alias("node")), "node", "left_anti")
    return out if root is None else out.where(F.col("node") != root)


def core(edges: DataFrame) -> DataFrame:
    """The edges that may be on a cycle: nodes without a parent or without a child are taken away until none is left."""
    left = staged(edges.select("parent", "child").where("parent is not null and child is not null").distinct())
    n = left.count()
    while True:
        left = staged(left.join(left.select(F.col("parent").alias("child")).distinct(), "child", "left_semi").join(left.select(F.col("child").alias("parent")).distinct(), "parent", "left_semi").select("parent", "child"))
        before, n = n, left.count()
        if n == before:
            return left


def on_cycle(edges: DataFrame) -> DataFrame:
    """Nodes that reach themselves by at least one edge. Only what may be on a cycle is closed."""
    edges = core(edges)
    reach = closure(edges)
    return reach.join(edges, (reach["ancestor"] == edges["child"]) & (reach["node"] == edges["parent"])).select(F.col("ancestor").alias("node")).distinct()


def cycle_paths(edges: DataFrame) -> DataFrame:
    """(path): one cycle, from its first node back to it, for every back edge of a depth-first walk from all nodes in order, with children in order.

    Such a walk comes to a node by the least simple path in order of its nodes, so that paths are found as in first_paths, from a root above all nodes.
    """
    own = core(edges)
    above = own.select(F.explode(F.array("parent", "child")).alias("child")).distinct().select(F.lit("").alias("parent"), "child")
    first = first_paths(own.unionByName(above), "")
    back = own.join(first.select(F.col("node").alias("parent"), "path"), "parent").where(F.array_contains("path", F.col("child")))
    at = F.array_position("path", F.col("child")).cast("int")
    return back.select(F.concat(F.slice("path", at, F.size("path") - at + 1), F.array("child")).alias("path"))


def multi_parented(edges: DataFrame, root: str | None = None) -> DataFrame:
    """(child, n_parents) of nodes with several parents."""
    out = edges.groupBy("child").agg(F.count_distinct("parent").alias("n_parents")).where("n_parents > 1")
    return out if root is None else out.where(F.col("child") != root)


def refile(edges: DataFrame, nodes: DataFrame, child: str, old: str, new: str) -> DataFrame:
    """Edges with child under another parent; as they are if one of the three is no node."""
    there = nodes.where(F.col("node").isin(child, old, new)).agg((F.count_distinct("node") == len({child, old, new})).alias("all_there"))
    moved = F.col("all_there") & (F.col("parent") == old) & (F.col("child") == child)
    kept = edges.crossJoin(F.broadcast(there)).where(~moved).select("parent", "child")  # one row
    added = there.where("all_there").select(F.lit(new).alias("parent"), F.lit(child).alias("child"))
    return kept.unionByName(added).distinct()


def follow(pointers: DataFrame) -> DataFrame:
    """(node, last) of pointers (node, target): where each chain ends; a node whose chain runs into a cycle stays where it is.

    Pointer jumping: chains halve each round, so that rounds are logarithmic in their length.
    """
    start = staged(pointers.where("target is not null").groupBy("node").agg(F.min("target").alias("at")))
    jump = start
    for _ in range(64):
        further = jump.select(F.col("node").alias("at"), F.col("at").alias("then"))
        done = staged(jump.join(further, "at", "left").select("node", F.coalesce("then", "at").alias("at")))
        moved = done.join(jump, "node").where(done["at"] != jump["at"])
        ended = moved.isEmpty()
        jump = done
        if ended:
            break
    # an end has no pointer; what still points somewhere is on a cycle or leads into one
    looping = jump.join(start.select(F.col("node").alias("at")), "at", "left_semi").select("node", F.col("node").alias("last"))
    return jump.join(start.select(F.col("node").alias("at")), "at", "left_anti").select("node", F.col("at").alias("last")).unionByName(looping)


def top_ancestors(tree: DataFrame) -> DataFrame:
    """(node, top) of a forest (node, parent); nodes without a parent are their own."""
    ends = follow(tree.select("node", F.col("parent").alias("target")))
    return tree.select("node").distinct().join(ends, "node", "left").select("node", F.coalesce("last", "node").alias("top"))


def first_paths(edges: DataFrame, root: str) -> DataFrame:
    """(node, path) by the first visit of a depth-first walk from root with children in order: the least path in order of its nodes."""
    edges = staged(edges.select("parent", "child").distinct())
    best = new = staged(edges.sparkSession.range(1).select(F.lit(root).alias("node"), F.array(F.lit(root)).alias("path")))
    while not new.isEmpty():
        tried = new.join(edges, new["node"] == edges["parent"]).where(~F.array_contains("path", F.col("child"))).groupBy(F.col("child").alias("node")).agg(F.min(F.concat("path", F.array("child"))).alias("path"))
        old = best.select("node", F.col("path").alias("old"))
        new = staged(tried.join(old, "node", "left").where("old is null or path < old").select("node", "path"))
        best = staged(best.join(new.select("node"), "node", "left_anti").unionByName(new))
    return best


def display_rows(edges: DataFrame, root: str) -> DataFrame:
    """(id, parent, node, is_pointer, path) of the tree that the walk shows: a node's first filing has its content, later ones point to it."""
    first = first_paths(edges, root)
    filed = edges.select("parent", "child").distinct().join(first.select(F.col("node").alias("parent"), F.col("path").alias("above")), "parent").join(first.select(F.col("node").alias("child"), "path"), "child")
    here = F.concat("above", F.array("child"))
    pointer = here != F.col("path")
    out = filed.select(F.when(pointer, F.concat("child", F.lit(":pointer"))).otherwise(F.col("child")).alias("id"), "parent", F.col("child").alias("node"), pointer.alias("is_pointer"), here.alias("path"))
    return out.unionByName(first.where(F.size("path") == 1).select(F.col("node").alias("id"), F.lit(None).cast("string").alias("parent"), "node", F.lit(False).alias("is_pointer"), "path"))


def below(rows: DataFrame, node: str) -> DataFrame:
    """The display rows under a node that has its content there, itself included: all that opening it to the end shows."""
    start = rows.where((F.col("node") == node) & ~F.col("is_pointer")).select(F.col("path").alias("__start"))
    return rows.crossJoin(F.broadcast(start)).where(F.slice("path", F.lit(1), F.size("__start")) == F.col("__start")).drop("__start")  # one row


def flat_nodes(rows: DataFrame, filings: DataFrame) -> DataFrame:
    """(id, title) of every node with a title: display rows, pointers aside, and the items filed under them (category, item)."""
    shown = rows.where(~F.col("is_pointer"))
    items = filings.join(shown.select(F.col("node").alias("category")), "category", "left_semi").select(F.col("item").alias("id"), F.col("item").alias("title"))
    return shown.select("id", F.col("node").alias("title")).unionByName(items).distinct()
