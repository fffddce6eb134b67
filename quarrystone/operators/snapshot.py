"""States as of given times, from full histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import month_sequence


def month_cutoffs(first: Column, last: Column, name: str = "cutoff"):
    """A column of the months' first days, to explode."""
    return F.explode(month_sequence(first, last)).alias(name)


def as_of(history: DataFrame, cutoffs: DataFrame, key: str, at: str, position: str, visible: str | None = None, cutoff: str = "cutoff") -> DataFrame:
    """Per cutoff and key: the newest visible row at or before the cutoff; at equal times the later in position. A key without one has none.

    A row counts from its time on until the next one of its key. Each row is turned into that interval once
    (one sort by key), and cutoffs (a short list of times, and a row each) meet only the rows whose interval holds
    them, so that history is not multiplied by the number of cutoffs before the choice.
    """
    from pyspark.sql import Window

    rows = history if visible is None else history.where(F.col(visible))
    order = Window.partitionBy(key).orderBy(F.col(at), F.col(position))
    spans = rows.where(F.col(at).isNotNull()).withColumn("__until", F.lead(at).over(order))
    times = cutoffs.agg(F.array_sort(F.collect_set(cutoff)).alias("__cutoffs"))
    held = spans.crossJoin(F.broadcast(times))  # one row
    met = F.filter("__cutoffs", lambda c: (c >= F.col(at)) & (F.col("__until").isNull() | (c < F.col("__until"))))
    return held.select(F.explode(met).alias(cutoff), *history.columns)


def month_histogram(revisions: DataFrame, page: str = "page_id", at: str = "ts", main: Column | None = None) -> DataFrame:
    """Per month: revisions, revisions of main pages, and main pages first seen in it."""
    own = F.lit(True) if main is None else main
    month = F.date_format(at, "yyyy-MM")
    every = revisions.groupBy(month.alias("month")).agg(F.count(F.lit(1)).alias("revisions"), F.count_if(own).alias("main_revisions"))
    new = revisions.where(own).groupBy(page).agg(F.min(at).alias("first")).groupBy(F.date_format("first", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("new_pages"))
    return every.join(new, "month", "full_outer").select("month", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("revisions", "main_revisions", "new_pages")])


def top_by_window(rows: DataFrame, windows: DataFrame, at: str, what: str, k: int) -> DataFrame:
    """(name, value, n, rank): the k most frequent values of `what` in each half-open window (name, lo, hi), ties by value.

    Counts are made first; only they are ranked.
    """
    return _ranked(in_windows(rows, windows, at).groupBy("name", F.col(what).alias("value")).agg(F.count(F.lit(1)).alias("n")), k)


def _ranked(counted: DataFrame, k: int) -> DataFrame:
    from pyspark.sql import Window

    order = Window.partitionBy("name").orderBy(F.desc("n"), "value")
    return counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def in_windows(rows: DataFrame, windows: DataFrame, at: str) -> DataFrame:
    """rows with the name of each half-open window (name, lo, hi) that they are in. Windows are cut into days, so that the join has an equality key."""
    days = windows.select("name", "lo", "hi", F.explode(F.sequence(F.to_date("lo"), F.to_date("hi"))).alias("__day"))
    return rows.withColumn("__day", F.to_date(at)).join(days, "__day").where((F.col(at) >= F.col("lo")) & (F.col(at) < F.col("hi"))).drop("__day", "lo", "hi")


#: Fixed value: characters of a comment that count.
COMMENT_LENGTH = 70


def burst_profile(revisions: DataFrame, windows: DataFrame, at: str = "timestamp", editors: int = 6, comments: int = 6, titles: int = 8) -> DataFrame:
    """(name, what, value, n, rank) of revisions (at, editor, comment, title) in each window: how many revisions and different titles, the
    most frequent editors, comments (their first COMMENT_LENGTH characters; none is empty) and titles, ties by value."""
    own = in_windows(revisions, windows, at).select("name", "editor", F.coalesce(F.substring("comment", 1, COMMENT_LENGTH), F.lit("")).alias("comment"), "title")
    out = None
    counted = {c: own.groupBy("name", F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n")) for c in ("editor", "comment", "title")}
    totals = own.groupBy("name").agg(F.count(F.lit(1)).alias("revisions"), F.count_distinct("title").alias("titles"))
    for what in ("revisions", "titles"):
        part = totals.select("name", F.lit(what).alias("what"), F.lit("").alias("value"), F.col(what).alias("n"), F.lit(1).alias("rank"))
        out = part if out is None else out.unionByName(part)
    for what, k in (("editor", editors), ("comment", comments), ("title", titles)):
        out = out.unionByName(_ranked(counted[what], k).select("name", F.lit(what).alias("what"), "value", "n", "rank"))
    return out
