"""Invariants as tables of what breaks them; empty tables are good news."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def broken_chain(log: DataFrame, date: str = "date", old_date: str = "old_date") -> DataFrame:
    """Entries whose old date is not the date of the entry before. For logs, which have an entry a month."""
    return log.withColumn("previous", F.lag(date).over(Window.orderBy(date))).where(F.col("previous").isNotNull() & (F.col("previous") != F.col(old_date)))


def month_gaps(rows: DataFrame, at: str) -> DataFrame:
    """(first, last, n) of runs of months without a gap."""
    months = rows.select(F.trunc(at, "month").alias("month")).distinct()
    number = F.year("month") * 12 + F.month("month")
    # one row a month: the window is over a short list
    island = number - F.row_number().over(Window.orderBy("month"))
    return months.withColumn("island", island).groupBy("island").agg(F.min("month").alias("first"), F.max("month").alias("last"), F.count(F.lit(1)).alias("n")).drop("island")


def oversized(sizes: DataFrame) -> DataFrame:
    """Pages whose stripped content is larger than their text."""
    return sizes.where("content_bytes > raw_bytes")


def missing_fields(table: DataFrame, fields: list[str]) -> DataFrame:
    """(field, n): how many rows lack a field."""
    counts = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in fields])
    return counts.select(F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in fields]), F.array(*fields))).alias("field", "n")).where("n > 0")


def stale_and_missing(expected: DataFrame, actual: DataFrame, name: str = "name") -> DataFrame:
    """(name, state): files that should be there and aren't, or are there and shouldn't."""
    gone = expected.select(name).join(actual.select(name), name, "left_anti").withColumn("state", F.lit("missing"))
    extra = actual.select(name).join(expected.select(name), name, "left_anti").withColumn("state", F.lit("stale"))
    return gone.unionByName(extra)


#: A published version's fields; the first is kept by hand, the others are dates.
VERSION_FIELDS = ("__code_version__", "__data_version__", "__content_version__")


def stamped(version: DataFrame, data: str, content: str | None) -> DataFrame:
    """A version (field, value) with the date of this run and, if known, the date of what it was made from; other fields stay."""
    new = [(VERSION_FIELDS[1], data)] + ([(VERSION_FIELDS[2], content)] if content else [])
    made = version.sparkSession.createDataFrame(new, "field string, value string")
    return version.where(~F.col("field").isin(*VERSION_FIELDS[1:])).select("field", "value").unionByName(made)


def version_problems(version: DataFrame) -> DataFrame:
    """(field, problem): fields that are missing or empty, or no dates where they should be."""
    want = version.sparkSession.createDataFrame([(f, k > 0) for k, f in enumerate(VERSION_FIELDS)], "field string, dated boolean")
    has = want.join(version, "field", "left")
    absent = F.coalesce(F.col("value"), F.lit("")) == ""
    return has.select("field", F.when(absent, "missing").when(F.col("dated") & ~F.col("value").rlike(r"^\d{4}-\d{2}-\d{2}$"), "no date").alias("problem")).where("problem is not null")


def log_behind(log: DataFrame, version: DataFrame, date: str = "date") -> DataFrame:
    """(newest, content) if the log's newest entry is not of the date that the version says the content has."""
    newest = log.agg(F.max(F.substring(F.col(date).cast("string"), 1, 10)).alias("newest"))
    content = version.where(F.col("field") == VERSION_FIELDS[2]).agg(F.max("value").alias("content"))
    return newest.crossJoin(F.broadcast(content)).where(~F.col("newest").eqNullSafe(F.col("content")))  # one row each


def root_problems(root: DataFrame, metrics: tuple[str, ...]) -> DataFrame:
    """(metric, value) of a root's statistics (one row) that are missing or not positive: a zero is a broken build, not a small corpus."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("bigint").alias("value")) for m in metrics])
    return root.select(F.explode(pairs).alias("p")).select("p.*").where("value is null or value <= 0")


class RootMissing(ValueError):
    """The hierarchy's root is not among its nodes."""


def require_root(nodes: DataFrame, root: str) -> None:
    if nodes.where(F.col("node") == root).isEmpty():
        raise RootMissing(root)
