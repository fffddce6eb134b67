"""Page forests from titles: nearest ancestors of slash-separated paths, allowlisted flat families, redirects."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ascii_digits, devanagari_digits, utrim
from .graph import follow


class Family(NamedTuple):
    """Titles that match `pattern` (a Java pattern for the whole title) have the parent that `parent` makes of them."""

    pattern: str
    parent: Callable[[Column], Column]


_CHAPTERS = r"^महाभारतम्-(\d+)-([^-]+)-(.+)$"
_HYMNS = r"^ऋग्वेद[ः:] सूक्तं ([०-९\d]+)\.([०-९\d]+)$"
#: Flat families of titles whose parents are known.
FAMILIES = (
    Family(_CHAPTERS, lambda t: F.concat(F.lit("महाभारतम्/"), F.regexp_extract(t, _CHAPTERS, 2))),
    Family(_HYMNS, lambda t: F.concat(F.lit("ऋग्वेदः मण्डल "), devanagari_digits(ascii_digits(F.regexp_extract(t, _HYMNS, 1)).cast("int").cast("string")))),
)


def normal_path(title: Column) -> Column:
    """The path with white space around its segments gone."""
    return F.array_join(F.transform(F.split(title, "/"), utrim), "/")


def resolved(pages: DataFrame) -> DataFrame:
    """(title, at) of pages (title, redirect_target): where a title's redirects end."""
    ends = follow(pages.select(F.col("title").alias("node"), F.col("redirect_target").alias("target")))
    return pages.select("title").distinct().join(ends.withColumnRenamed("node", "title"), "title", "left").select("title", F.coalesce("last", "title").alias("at"))


def page_tree(pages: DataFrame, families: tuple[Family, ...] = FAMILIES) -> DataFrame:
    """(title, parent) of pages (title, redirect_target, position).

    A path's parent is the first of its candidates that is a page after redirects and not the title itself: the text before the
    last slash, then its shorter prefixes with trimmed segments, each as it is, then any page of the same trimmed form (the one first
    in position). A title without a slash has the parent of the first family that it fits, if that is a page; none is made up.
    """
    where = resolved(pages)
    titles = pages.select("title").distinct()
    real = where.join(titles.withColumnRenamed("title", "at"), "at", "left_semi")  # redirects that end at a page
    segments = F.split("title", "/")
    prefixes = F.transform(F.sequence(F.size(segments) - 1, F.lit(1), F.lit(-1)), lambda k: F.array_join(F.transform(F.slice(segments, F.lit(1), k), utrim), "/"))
    literal = F.regexp_extract("title", r"(?s)^(.*)/[^/]*$", 1)
    slashed = pages.where(F.col("title").contains("/")).select("title", F.posexplode(F.concat(F.array(literal), prefixes)).alias("rank", "candidate"))
    exact = slashed.join(real.select(F.col("title").alias("candidate"), "at"), "candidate").select("title", F.col("rank").alias("r"), F.lit(0).cast("bigint").alias("p"), "at")
    forms = pages.select(normal_path(F.col("title")).alias("candidate"), F.col("title").alias("page"), F.col("position").cast("bigint").alias("p"))
    loose = slashed.where("rank > 0").join(forms, "candidate").join(real.select(F.col("title").alias("page"), "at"), "page").select("title", F.col("rank").alias("r"), (F.col("p") + 1).alias("p"), "at")
    by_path = exact.unionByName(loose).where("at <> title").groupBy("title").agg(F.min_by("at", F.struct("r", "p", "at")).alias("parent"))
    flat = pages.where(~F.col("title").contains("/"))
    made = F.lit(None).cast("string")
    for family in reversed(families):
        made = F.when(F.col("title").rlike("(?U)" + family.pattern), family.parent(F.col("title"))).otherwise(made)
    by_family = flat.select("title", made.alias("candidate")).join(real.select(F.col("title").alias("candidate"), "at"), "candidate").where("at <> title").select("title", F.col("at").alias("parent"))
    return titles.join(by_path.unionByName(by_family), "title", "left")


def skip_redirects(tree: DataFrame, redirects: DataFrame) -> DataFrame:
    """The tree without redirect pages; their children move up to the parent, by one level."""
    gone = redirects.select(F.col("title").alias("parent"), F.lit(True).alias("skipped")).distinct()
    up = tree.select(F.col("title").alias("parent"), F.col("parent").alias("above"))
    out = tree.join(redirects.select("title"), "title", "left_anti").join(gone, "parent", "left").join(up, "parent", "left")
    return out.select("title", F.when(F.col("skipped"), F.col("above")).otherwise(F.col("parent")).alias("parent"))


def path_prefixes(paths: DataFrame, column: str = "path") -> DataFrame:
    """(path, ancestor, depth) for every proper prefix of a slash-separated path."""
    parts = F.split(column, "/")
    return paths.where(F.size(parts) > 1).select(F.col(column).alias("__path"), F.posexplode(F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))).alias("depth", "ancestor")).withColumnRenamed("__path", "path")


def unresolvable(tree: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """(family, n) of paths without a parent, by first segment; redirect pages aside."""
    left = tree if redirects is None else tree.join(redirects.select("title"), "title", "left_anti")
    return left.where(F.col("parent").isNull() & F.col("title").contains("/")).groupBy(utrim(F.substring_index("title", "/", 1)).alias("family")).agg(F.count(F.lit(1)).alias("n"))
