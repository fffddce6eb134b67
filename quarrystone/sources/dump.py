"""XML exports of pages and of full histories, by Spark's XML parser (bzip2 and gzip by suffix)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_TEXT = "text struct<_VALUE: string, _deleted: string>"
_REVISION = f"struct<id: bigint, timestamp: string, contributor: struct<username: string, ip: string, id: bigint>, comment: string, {_TEXT.replace('text ', 'text: ', 1)}>"
PAGE_SCHEMA = f"title string, ns int, id bigint, redirect struct<_title: string>, revision array<{_REVISION}>"

# blanks at the ends of titles and texts count
_PARSING = {"ignoreSurroundingSpaces": "false", "mode": "PERMISSIVE"}

_END = "</page>"
#: An instruction that is not the first line of an export in UTF-8.
_INSTRUCTION = r"""<\?(?!xml version=["']1\.0["'](?: encoding=["'](?i:utf-8)["'])?(?: standalone=["'](?:yes|no)["'])?\s*\?>)"""
#: Files that no task can read from the middle.
_PACKED = r"\.(?:gz|deflate|snappy|lz4|zst)$"


def _found(tag: str) -> Column:
    """The elements `tag` of a piece of an export that ends before </page>."""
    value = F.col("value")
    if tag == "page":
        return F.when(value.contains("<page>"), F.array(F.concat(F.lit("<page>"), F.substring_index(value, "<page>", -1), F.lit(_END)))).otherwise(F.array().cast("array<string>"))
    return F.regexp_extract_all(value, F.lit(rf"<{tag}(?:\s[^<>]*)?(?:/>|>[^<]*</{tag}>)"), F.lit(0))


def _plain(tag: str) -> Column:
    """Whether a piece has nothing in which </page> may be no end (comments, CDATA, instructions), no other end, only elements that are found, and UTF-8."""
    value = F.col("value")
    odd = value.contains("<!") | value.contains("</page") | value.contains("\0") | (value.contains("<?") & value.rlike(_INSTRUCTION))
    return ~odd & F.is_valid_utf8(value) & (F.regexp_count(value, F.lit(rf"<{tag}[\s/>]")) == F.size(_found(tag)))


def _rows(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """A row for each element `tag`.

    The XML source gives a file to one task, of whatever size. So files are cut at the ends of pages, as texts are at the ends of lines, and the pieces are
    parsed alone. All pieces are looked at first: the XML source reads a file whole where a cut could be wrong, and where a codec lets no task start in the middle.
    A page that can't be parsed gives a row of nulls; in a file read whole, it is the last row.
    """
    file = F.col("_metadata.file_path")
    pieces = spark.read.option("lineSep", _END).text(path).where(~file.rlike(_PACKED))
    # the last piece of a file, and no other, is without a page
    files = pieces.groupBy(file.alias("file")).agg(F.bool_and(_plain(tag)).alias("plain"), F.count_if(~F.col("value").contains("<page>")).alias("ends"))
    odd = [r["file"] for r in files.where("not plain or ends <> 1").collect()]
    # inline() parses once, where a filter on a field of from_xml() would parse again
    cut = pieces.where(~file.isin(odd)).select(F.explode(_found(tag)).alias("xml")).select(F.inline(F.array(F.from_xml("xml", schema, _PARSING))))
    whole = spark.read.format("xml").option("rowTag", tag).options(**_PARSING).schema(schema).load(path)
    return cut.unionByName(whole.where(file.rlike(_PACKED) | file.isin(odd)).select(cut.columns))


def read_pages(spark: SparkSession, path: str, namespaces: list[int] | None = None) -> DataFrame:
    """(page_id, ns, title, redirect_target, text, timestamp, rev_id) of an export; the last revision of a page, '' and 0 for what is absent.

    A page is parsed before it can be filtered: for repeated use, land the result as Parquet by ns (see sources.tables.land).
    """
    rows = _rows(spark, path, "page", PAGE_SCHEMA)
    if namespaces is not None:
        rows = rows.where(F.col("ns").isin(namespaces))
    last = F.try_element_at("revision", F.lit(-1))
    return rows.select(
        F.coalesce("id", F.lit(0)).alias("page_id"),
        "ns",
        "title",
        F.col("redirect._title").alias("redirect_target"),
        F.coalesce(last["text"]["_VALUE"], F.lit("")).alias("text"),
        F.coalesce(last["timestamp"], F.lit("")).alias("timestamp"),
        F.coalesce(last["id"], F.lit(0)).alias("rev_id"),
    )


def read_revisions(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, ns, title, position, rev_id, timestamp, editor, comment, visible, text) of every revision of a full history."""
    rows = _rows(spark, path, "page", PAGE_SCHEMA).select("id", "ns", "title", F.posexplode("revision").alias("position", "r"))
    return rows.select(
        F.col("id").alias("page_id"),
        "ns",
        "title",
        "position",
        F.col("r.id").alias("rev_id"),
        F.col("r.timestamp").alias("timestamp"),
        editor(F.col("r.contributor.username"), F.col("r.contributor.ip")).alias("editor"),
        F.col("r.comment").alias("comment"),
        F.coalesce(F.col("r.text._deleted") != "deleted", F.lit(True)).alias("visible"),
        F.col("r.text._VALUE").alias("text"),
    )


def editor(username: Column, ip: Column) -> Column:
    return F.coalesce(username, ip, F.lit("?"))


def read_namespaces(spark: SparkSession, path: str) -> DataFrame:
    """(ns, name); the main namespace has the empty name."""
    rows = _rows(spark, path, "namespace", "_key int, _VALUE string")
    return rows.where("_key is not null").select(F.col("_key").alias("ns"), F.coalesce("_VALUE", F.lit("")).alias("name")).distinct()


class NamespaceMissing(LookupError):
    """An export names no such namespace."""


def namespace_id(namespaces: DataFrame, name: str, fallback: int | None = None, optional: bool = False) -> int | None:
    """A namespace's id by its localized name, else the fallback id if the export has it. A site has a few dozen namespaces."""
    found = {r["name"]: r["ns"] for r in namespaces.collect()}
    if name in found:
        return found[name]
    if fallback is not None and fallback in found.values():
        return fallback
    if optional:
        return None
    raise NamespaceMissing(name)


def write_snapshots(pages: DataFrame, path: str, cutoff: str = "cutoff") -> None:
    """One export per cutoff: rows (cutoff, ns, title, page_id, redirect_target, text, timestamp, rev_id) as XML in a folder of each cutoff.

    The committer makes a folder whole or absent.
    """
    page = pages.select(
        cutoff,
        "title",
        "ns",
        F.col("page_id").alias("id"),
        F.when(F.col("redirect_target").isNotNull(), F.struct(F.col("redirect_target").alias("_title"))).alias("redirect"),
        F.struct(F.col("rev_id").alias("id"), "timestamp", F.struct(F.col("text").alias("_VALUE")).alias("text")).alias("revision"),
    )
    page.write.format("xml").option("rootTag", "mediawiki").option("rowTag", "page").partitionBy(cutoff).mode("overwrite").save(path)
