"""Constraint checks. A failed check condemns its unit, not the job."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirframe.fixed import FIRST_YEAR, LAST_YEAR


def newest_year() -> int:
    """The last year that has a partition: this year, and not before ``LAST_YEAR``."""
    return max(LAST_YEAR, datetime.datetime.now(datetime.timezone.utc).year)


def routable(day: Column, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR) -> Column:
    """There is a yearly partition for this date."""
    return day.between(F.lit(datetime.date(first_year, 1, 1)), F.lit(datetime.date(last_year, 12, 31)))


class ConstraintBreach(RuntimeError):
    """Stored rows break a constraint of their table."""


def breaches(rows: DataFrame, name: str, key: list[str], required: list[str]) -> DataFrame:
    """``breach`` texts of repeated keys and of missing required values."""
    again = duplicates(rows, key).select(F.concat(F.lit(f"{name}: repeated key "), F.concat_ws(", ", *[F.col(k).cast("string") for k in key])).alias("breach"))
    absent = rows.filter(missing_required([F.col(c) for c in required]))
    return again.unionByName(absent.select(F.lit(f"{name}: a required value is missing").alias("breach")))


def missing_required(columns: list[Column]) -> Column:
    condition = F.lit(False)
    for column in columns:
        condition = condition | column.isNull()
    return condition


def unit_status(rows: DataFrame, unit: list[str], bad: Column) -> DataFrame:
    """Per unit: row count, bad rows, and whether it may be written and marked done."""
    flagged = F.coalesce(bad, F.lit(True))
    return (
        rows.groupBy(*unit)
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(flagged).alias("n_bad"))
        .withColumn("status", F.when(F.col("n_bad") > 0, "failed").otherwise("done"))
    )


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Foreign keys without a parent, with the number of child rows.

    Child rows are counted per key before the join, so a hot key joins once.
    """
    references = (
        child.filter(F.col(foreign_key).isNotNull())
        .groupBy(foreign_key)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    parents = parent.select(F.col(key).alias(foreign_key)).distinct()
    return references.join(parents, foreign_key, "left_anti")


def duplicates(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Full keys that occur more than once."""
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return frame.filter(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
