"""Defects of structure: families of titles, shared properties, red links, bulk imports, missing files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import url_host, urls_in, utrim

#: Hosts of machine-readable text collections, and headers that name a page's source.
REPOSITORIES = (
    "gretil.sub.uni-goettingen.de",
    "sub.uni-goettingen.de",
    "detu.sub.uni-goettingen.de",
    "sanskritdocuments.org",
    "sarit.indology.info",
    "kjc-fs-cluster.kjc.uni-heidelberg.de",
    "muktalib7.com",
    "tipitakapali.org",
    "glossaries.dila.edu.tw",
    "titus.uni-frankfurt.de",
    "granthamandira.net",
    "peterffreund.com",
    "sanskritworld.in",
    "sanskrit.uohyd.ac.in",
    "guruguha.org",
)
SOURCE_HEADER = r"(?iU)={2,}\s*(स्रोतः|स्रोतम्|स्रोतस्|स्रोत|मूलपाठः|आधारः|Sources?)\s*={2,}"

#: Fixed value: titles of a family, stem and rest.
_SEPARATED = r"(?U)^(.+?)\s*[-–.]\s*(\S.*)$"


def space_prefixes(titles: DataFrame) -> DataFrame:
    """(prefix, title): titles that begin with another title and a space. Prefixes are cut from the longer title and joined by equality."""
    parts = F.split("title", " ")
    cut = titles.where(F.size(parts) > 1).select("title", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, F.lit(1), k), " "))).alias("prefix"))
    return cut.join(titles.select(F.col("title").alias("prefix")).distinct(), "prefix").select("prefix", "title").distinct()


def separator_families(titles: DataFrame, least: int = 2) -> DataFrame:
    """(stem, n) of titles stem-rest, stem–rest or stem.rest whose stem is a title, with at least `least` members."""
    pattern = _SEPARATED
    stems = titles.where(F.col("title").rlike(pattern)).select("title", utrim(F.regexp_extract("title", pattern, 1)).alias("stem"))
    return stems.join(titles.select(F.col("title").alias("stem")).distinct(), "stem").groupBy("stem").agg(F.count_distinct("title").alias("n")).where(F.col("n") >= least)


def shared_by_all(tree: DataFrame, tags: DataFrame) -> DataFrame:
    """(parent, tag) of the tags (title, tag) that all children of a parent have and it has not."""
    kids = tree.where("parent is not null").select("parent", "title").distinct()
    total = kids.groupBy("parent").agg(F.count(F.lit(1)).alias("n"))
    held = kids.join(tags.distinct(), "title").groupBy("parent", "tag").agg(F.count(F.lit(1)).alias("m"))
    return held.join(total, "parent").where("m = n").select("parent", "tag").join(tags.select(F.col("title").alias("parent"), "tag").distinct(), ["parent", "tag"], "left_anti")


def red_links(mentioned: DataFrame, pages: DataFrame) -> DataFrame:
    """(title, n_mentions) of titles that are mentioned and no page."""
    return mentioned.groupBy("title").agg(F.count(F.lit(1)).alias("n_mentions")).join(pages.select("title").distinct(), "title", "left_anti")


def bulk_imports(pages: DataFrame, repositories: tuple[str, ...] | DataFrame = REPOSITORIES, header: str = SOURCE_HEADER) -> DataFrame:
    """(title, n_urls, repo_hits) of pages nearly all of whose URLs are of text collections, or with a source header and such a URL. The collections' hosts are given, or a table (host)."""
    hosts = F.transform(urls_in(F.col("text")), url_host)
    out = pages.select("title", "text", hosts.alias("hosts")).select("title", "hosts", F.size("hosts").alias("n_urls"), F.col("text").rlike(header).alias("headed"))
    if isinstance(repositories, DataFrame):
        each = out.withColumn("__page", F.monotonically_increasing_id()).select("__page", "title", "n_urls", "headed", F.explode("hosts").alias("host"))
        out = each.join(repositories.select("host").distinct(), "host", "left_semi").groupBy("__page", "title", "n_urls", "headed").agg(F.count(F.lit(1)).cast("int").alias("repo_hits"))
    else:
        out = out.withColumn("repo_hits", F.size(F.filter("hosts", lambda h: h.isin(list(repositories)))))
    return out.where((F.col("repo_hits") > 0) & ((F.col("repo_hits") >= F.greatest(F.lit(1), F.col("n_urls") - 1)) | F.col("headed"))).select("title", "n_urls", "repo_hits")


def broken_transclusions(used: DataFrame, leaves: DataFrame, files: DataFrame) -> DataFrame:
    """Per index that pages use, that has leaves and whose file is missing: how many leaves, and the first and last."""
    missing = used.select("index_title").distinct().join(files.select("index_title"), "index_title", "left_anti")
    return leaves.join(missing, "index_title", "left_semi").groupBy("index_title").agg(F.count(F.lit(1)).alias("n_leaves"), F.min_by("leaf_title", F.struct("n", "leaf_title")).alias("first"), F.max_by("leaf_title", F.struct("n", "leaf_title")).alias("last"))


def sample_of(groups: DataFrame, group: str, member: str, k: int) -> DataFrame:
    """Groups by size with their first k members: (group, n, member, rank). The size is counted apart, so that only k rows a group are carried."""
    sizes = groups.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(group).orderBy(member)
    return groups.select(group, member).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).join(sizes, group)


def family_health(pages: DataFrame, tree: DataFrame, families: list[tuple[str, str]]) -> DataFrame:
    """Per family (name, pattern): how many titles fit it, and how many of these have no parent."""
    rows = pages.select("title").join(tree.select("title", "parent"), "title", "left")
    named = rows.select(F.explode(F.array(*[F.struct(F.lit(n).alias("family"), F.col("title").rlike("(?U)" + p).alias("fits"), F.col("parent").isNull().alias("stray")) for n, p in families])).alias("f"))
    return named.groupBy("f.family").agg(F.count_if("f.fits").alias("n_fits"), F.count_if(F.expr("f.fits and f.stray")).alias("n_unparented"))


def family_problems(pages: DataFrame, tree: DataFrame, families: list[tuple[str, str]]) -> DataFrame:
    """(family, problem, subject, n) of families (name, pattern) of titles without a slash among pages (title, redirect_target).

    dead: no title fits; unparented: n fitting titles have no parent, the first is the subject; missing: a parent of n fitting titles is no
    page; redirect: it is a redirect.
    """
    rows = pages.where(~F.col("title").contains("/")).select("title").join(tree.select("title", "parent"), "title", "left")
    fits = F.filter(F.array(*[F.when(F.col("title").rlike("(?U)" + p), F.lit(n)) for n, p in families]), lambda x: x.isNotNull())
    named = rows.select("title", "parent", F.explode(fits).alias("family"))
    stray = named.where("parent is null").groupBy("family").agg(F.min("title").alias("subject"), F.count(F.lit(1)).alias("n")).select("family", F.lit("unparented").alias("problem"), "subject", "n")
    there = pages.select(F.col("title").alias("subject"), F.lit(True).alias("there"), "redirect_target").dropDuplicates(["subject"])
    ends = named.where("parent is not null").groupBy("family", F.col("parent").alias("subject")).agg(F.count(F.lit(1)).alias("n")).join(there, "subject", "left")
    wrong = ends.where("there is null or redirect_target is not null").select("family", F.when(F.col("there").isNull(), "missing").otherwise("redirect").alias("problem"), "subject", "n")
    every = pages.sparkSession.createDataFrame([(n,) for n, _ in families], "family string")
    dead = every.join(named.select("family").distinct(), "family", "left_anti").select("family", F.lit("dead").alias("problem"), F.lit(None).cast("string").alias("subject"), F.lit(0).cast("bigint").alias("n"))
    return stray.unionByName(wrong).unionByName(dead)


def tagged_leaves(leaves: DataFrame) -> DataFrame:
    """(title, categories) of leaves that have categories of their own, which belong to the index."""
    return leaves.where(F.size("categories") > 0).select("title", F.array_sort(F.array_distinct("categories")).alias("categories"))


def largest_groups(rows: DataFrame, group: str, k: int) -> DataFrame:
    """(group, n, rank) of the k largest groups, ties by name. Only k rows are ranked."""
    top = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), group).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), group)))


def token_groups(titles: DataFrame, least: int = 2) -> DataFrame:
    """(prefix, n, depth) of the prefixes by whole words that at least `least` titles share, without those that a longer one shares as widely."""
    parts = F.split("title", " ")
    cut = titles.select(F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, F.lit(1), k), " ").alias("prefix")))).alias("p")).select("p.*")
    counted = cut.groupBy("prefix", "depth").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    longer = counted.where("depth > 1").select(F.regexp_extract("prefix", r"(?s)^(.*) [^ ]*$", 1).alias("prefix"), "n").distinct()
    return counted.join(longer, ["prefix", "n"], "left_anti")


def findings(**checks: DataFrame) -> DataFrame:
    """(check, subject, n) of several checks' tables: their first column is the subject, their first column of whole numbers the count, else 1."""
    out = None
    for name, df in checks.items():
        numbers = [c for c, kind in df.dtypes[1:] if kind in ("int", "bigint")]
        rows = df.select(F.lit(name).alias("check"), F.col(df.columns[0]).cast("string").alias("subject"), (F.col(numbers[0]) if numbers else F.lit(1)).cast("bigint").alias("n"))
        out = rows if out is None else out.unionByName(rows)
    return out
