"""Pages made of other pages: ranges and sets of numbered leaves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import first_attribute_indexes, transclusion_ranges


def page_ranges(pages: DataFrame) -> DataFrame:
    """(title, index_title, from_n, to_n, include) of every <pages> tag."""
    return pages.select("title", F.explode(transclusion_ranges(F.col("text"))).alias("r")).select("title", "r.*")


def index_pages(pages: DataFrame) -> DataFrame:
    """Distinct (index_title, title) of the tags whose first attribute is the index; either direction is a grouping of it."""
    return pages.select(F.explode(first_attribute_indexes(F.col("text"))).alias("index_title"), "title").distinct()


def resolved_leaves(ranges: DataFrame, leaves: DataFrame) -> DataFrame:
    """Distinct (title, leaf_title) of the leaves (index_title, leaf_title, n) that a range has: those of its set, or those between its ends; an end that is null is open. Leaves without a number are in none.

    The index is the join's key, so that the range is only tested within an index.
    """
    between = (F.col("n") >= F.coalesce("from_n", F.col("n"))) & (F.col("n") <= F.coalesce("to_n", F.col("n")))
    meets = F.when(F.col("include").isNotNull(), F.array_contains("include", F.col("n"))).otherwise(between)
    return ranges.join(leaves.where("n is not null"), "index_title").where(meets).select("title", "leaf_title").distinct()


def with_leaf_sizes(sizes: DataFrame, used: DataFrame, leaf_sizes: DataFrame, columns: tuple[str, ...] = ("raw_bytes", "content_bytes", "transliterated_bytes")) -> DataFrame:
    """Sizes of pages (title) with those of the leaves (leaf_title) that they use (title, leaf_title) added."""
    added = used.join(leaf_sizes, "leaf_title").groupBy("title").agg(*[F.sum(c).alias(f"leaf_{c}") for c in columns])
    return sizes.join(added, "title", "left").select(*[c for c in sizes.columns if c not in columns], *[(F.col(c) + F.coalesce(f"leaf_{c}", F.lit(0))).alias(c) for c in columns])
