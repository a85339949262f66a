"""What was left out, and why: one row for each malformed body, rejected poll and failed unit.

Rows are appended below the tables' root. A repaired body or unit leaves its old rows there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirframe.sources import files
from weirframe.sources.tables import TableStore

NAME = "quarantine"
COLUMNS = "job string, unit string, source string, page int, pos int, document string, reason string"
MALFORMED = "malformed body"


def add(store: TableStore, rows: DataFrame) -> None:
    stamped = rows.select(*[c.split()[0] for c in COLUMNS.split(", ")], F.current_timestamp().alias("at"))
    stamped.write.mode("append").parquet(f"{store.root}/{NAME}")


def read(spark: SparkSession, store: TableStore) -> DataFrame:
    path = f"{store.root}/{NAME}"
    schema = f"{COLUMNS}, at timestamp"
    return spark.read.schema(schema).parquet(path) if files.exists(spark, path) else spark.createDataFrame([], schema)


def malformed_bodies(documents: DataFrame) -> DataFrame:
    """Bodies of polls that are no valid JSON, from the parse that found them."""
    return documents.filter("malformed").select(
        F.lit("poll").alias("job"), F.col("poll").alias("unit"), "source", "page", F.lit(None).cast("int").alias("pos"),
        F.coalesce("area", "document").alias("document"), F.lit(MALFORMED).alias("reason"),
    )


def entry(spark: SparkSession, job: str, unit: str, page: int | None, pos: int | None, reason: str) -> DataFrame:
    return spark.createDataFrame([(job, unit, None, page, pos, None, reason)], COLUMNS)


def failed_units(job: str, reasons: DataFrame) -> DataFrame:
    """Units that failed, with the first reason (``first_bad``) and its place."""
    return reasons.select(
        F.lit(job).alias("job"), F.concat_ws(":", "station_ref", "year").alias("unit"), F.lit(None).cast("string").alias("source"),
        F.col("first_bad.page").cast("int").alias("page"), F.col("first_bad.pos").cast("int").alias("pos"),
        F.lit(None).cast("string").alias("document"), F.col("first_bad.reason").alias("reason"),
    )
