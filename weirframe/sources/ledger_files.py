"""The work ledger on disk: text lines ``ref:year``, appended after the rows are written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirframe.operators import ledger
from weirframe.sources import files


def read(spark: SparkSession, path: str) -> DataFrame:
    if files.exists(spark, path):
        lines = spark.read.text(path)
    else:
        lines = spark.createDataFrame([], "value string")
    return ledger.parse(lines)


def append(finished: DataFrame, done: DataFrame, path: str) -> None:
    """Adds the finished keys that the ledger lacks."""
    added = ledger.additions(finished, done, ["unit_key"])
    added.select(F.col("unit_key").alias("value")).hint("rebalance").write.mode("append").text(path)


def reset(spark: SparkSession, path: str) -> None:
    files.remove(spark, path)
