"""Tables kept between the rounds of an iterative plan, in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a local folder if all runs on one machine, else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    return found or "file:///tmp/checkpoints"


def staged(df: DataFrame) -> DataFrame:
    """The rows of df, written once and read again: lineage is cut, and lost executors cost nothing.

    Tables are in a folder of the application, which may be deleted when it has ended.
    """
    path = f"{shared_dir(df.sparkSession)}/staged/{df.sparkSession.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
