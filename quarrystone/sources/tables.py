"""Other sources and sinks: JSON, manifests, versions, content tables with a schema version, trees."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SCHEMA_VERSION = 1


def land(pages: DataFrame, path: str, by: str = "ns") -> None:
    """Parquet partitioned by namespace, so that later scans read only the namespaces and columns that they need."""
    pages.write.partitionBy(by).mode("overwrite").parquet(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents, gzipped or not."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def write_json_gz(df: DataFrame, path: str) -> None:
    df.write.option("compression", "gzip").mode("overwrite").json(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whatever store the path names."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def read_text_index(spark: SparkSession, path: str) -> DataFrame | None:
    """(ns, pageid, path, title) of a JSON-lines index; blank and malformed lines, and rows without a page, are skipped. None if there is no index: what has text is unknown then, which is not the same as nothing (see rollup.index_items)."""
    if not exists(spark, path):
        return None
    rows = spark.read.schema("ns string, pageid bigint, path string, title string").option("mode", "DROPMALFORMED").json(path)
    return rows.where("ns in ('main', 'index') and pageid is not null")


def text_keys(index: DataFrame, files: DataFrame) -> DataFrame:
    """(key, path): by page id, by title and by title without its prefix, of the rows whose file is there."""
    bare = F.regexp_replace("title", r"^[^:]*:", "")
    keys = F.array_distinct(F.array(F.col("pageid").cast("string"), F.col("title"), bare))
    return index.join(files.select("path").distinct(), "path", "left_semi").select(F.explode(keys).alias("key"), "path")


def parse_manifest(lines: DataFrame, column: str = "value") -> DataFrame:
    """(name, digest) of lines `digest  name`."""
    parts = F.split(column, "  ", 2)
    return lines.where(F.size(parts) == 2).select(F.trim(parts[1]).alias("name"), F.lower(F.trim(parts[0])).alias("digest"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return parse_manifest(spark.read.text(path))


def verified(manifest: DataFrame, files: DataFrame, bits: int = 256) -> DataFrame:
    """(name, state) of files (name, content): ok, mismatch or missing."""
    own = files.select("name", (F.sha2("content", bits) if bits else F.md5("content")).alias("own"))
    state = F.when(F.col("own").isNull(), "missing").when(F.col("own") == F.col("digest"), "ok").otherwise("mismatch")
    return manifest.join(own, "name", "left").select("name", state.alias("state"))


def one_per_month(dates: DataFrame, date: str = "date") -> DataFrame:
    """The earliest date of each month."""
    return dates.groupBy(F.date_format(date, "yyyy-MM").alias("month")).agg(F.min(date).alias(date))


def latest_complete(months: DataFrame, back: int = 6) -> DataFrame:
    """The newest complete month (month, complete) among the last `back`."""
    newest = months.agg(F.max("month").alias("newest"))
    return months.crossJoin(F.broadcast(newest)).where(F.col("complete") & (F.col("month") > F.add_months("newest", -back))).agg(F.max("month").alias("month"))


def newest_names(files: DataFrame, name: str = "name") -> DataFrame:
    """(stem, name): of files whose names differ in an ISO date, the one with the latest."""
    return files.where(F.col(name).rlike(r"[0-9]{4}-[0-9]{2}-[0-9]{2}")).groupBy(F.regexp_replace(name, r"[0-9]{4}-[0-9]{2}-[0-9]{2}", "*").alias("stem")).agg(F.max(name).alias(name))


def first_available(makers: list, *args):
    """What the first of several makers gives, from the cheapest to the dearest; one that has nothing gives None."""
    for make in makers:
        if (made := make(*args)) is not None:
            return made
    raise LookupError("no source has it")


def preferred(sources: DataFrame, key: str = "month", priority: str = "priority") -> DataFrame:
    """One row a key: that of the first source in priority."""
    return sources.withColumn("__r", F.row_number().over(Window.partitionBy(key).orderBy(priority))).where("__r = 1").drop("__r")


def version_value(text: Column, key: str) -> Column:
    """The value of `key: value` or `key=value` in a version file."""
    return F.nullif(F.regexp_extract(text, rf"(?m)^\s*{key}\s*[:=]\s*(\S+)", 1), F.lit(""))


class VersionMismatch(ValueError):
    """A content table was written in another schema version."""


def write_content(content: DataFrame, path: str, snapshot: str) -> None:
    """Content of a snapshot, partitioned by its date and stamped with the schema's version."""
    content.withColumns({"schema_version": F.lit(SCHEMA_VERSION), "snapshot_date": F.lit(snapshot)}).write.partitionBy("snapshot_date").mode("append").parquet(path)


def read_content(spark: SparkSession, path: str, snapshot: str) -> DataFrame:
    rows = spark.read.parquet(path).where(F.col("snapshot_date") == snapshot)
    found = [r[0] for r in rows.select("schema_version").distinct().limit(2).collect()]
    if found and found != [SCHEMA_VERSION]:
        raise VersionMismatch(str(found))
    return rows.drop("schema_version")


def nested(rows: DataFrame, root: str, limit: int = 1_000_000) -> dict:
    """The tree of display rows (id, parent, node, is_pointer, stats) as one nested object, for a browser. Refuses more than `limit` rows, which no page shows."""
    got = rows.select("id", "parent", "node", "is_pointer", "stats").limit(limit + 1).collect()
    if len(got) > limit:
        raise ValueError(f"more than {limit} nodes")
    kids: dict[str | None, list] = {}
    for r in sorted(got, key=lambda r: (r["node"], r["id"])):
        kids.setdefault(r["parent"], []).append(r)
    made = {"id": root, "children": []}
    open_ = [(made, root)]
    while open_:
        at, node = open_.pop()
        for r in kids.get(node, ()):
            child = {"id": r["id"], "title": r["node"], "stats": r["stats"].asDict() if r["stats"] else None}
            if not r["is_pointer"]:
                child["children"] = []
                open_.append((child, r["node"]))
            at["children"].append(child)
    return made


def write_tree(tree: dict, path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(tree, f, ensure_ascii=False, separators=(",", ":"))
