"""Streams of revisions and events: monthly counts with a watermark, and the net state of items."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 64) -> DataFrame:
    """Parquet files of a folder as they come."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def monthly_counts(rows: DataFrame, at: str = "ts", late: str = "7 days") -> DataFrame:
    """(month, n), final once the watermark has passed a month's end. A month is no fixed interval, so that windows of a day are counted, and months are sums of them."""
    daily = rows.withWatermark(at, late).groupBy(F.window(at, "1 day").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return daily.select(F.date_format("w.start", "yyyy-MM").alias("month"), F.col("w.start").alias("day"), "n")


def latest_states(rows: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """(key, at, value): each key's newest value so far, by state kept per key; rows that come late do not turn it back."""

    def step(k: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        when, what = state.get if state.exists else (None, None)
        for pdf in batches:
            row = pdf.sort_values("at", kind="stable").iloc[-1]
            if when is None or row["at"] >= when:
                when, what = row["at"], row["value"]
        state.update((when, what))
        yield pd.DataFrame({"key": [k[0]], "at": [when], "value": [what]})

    kind, time = rows.schema[key].dataType.simpleString(), rows.schema[at].dataType.simpleString()
    named = rows.select(F.col(key).alias("key"), F.col(at).alias("at"), F.col(value).cast("string").alias("value"))
    return named.groupBy("key").applyInPandasWithState(step, f"key {kind}, at {time}, value string", f"at {time}, value string", "update", "NoTimeout")


def run_once(stream: DataFrame, table: str, checkpoint: str, mode: str = "append"):
    """What is there now into a table in memory, then stop; a later run goes on from the checkpoint."""
    query = stream.writeStream.format("memory").queryName(table).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
