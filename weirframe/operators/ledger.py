"""The work ledger: which (reference, year) units are done."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirframe.functions.scalars import unit_key, unit_ref, unit_year


def parse(lines: DataFrame, column: str = "value") -> DataFrame:
    """Text lines -> distinct trimmed keys, with reference and year split on the last colon."""
    key = F.trim(F.col(column))
    return (
        lines.select(key.alias("unit_key"))
        .filter("unit_key != ''")
        .distinct()
        .withColumn("ref", unit_ref(F.col("unit_key")))
        .withColumn("year", unit_year(F.col("unit_key")))
    )


def unit_grid(stations: DataFrame, start_year: int, end_year: int) -> DataFrame:
    """Every station with every year of the range, both ends inclusive."""
    years = F.sequence(F.lit(start_year), F.lit(end_year)) if start_year <= end_year else F.array().cast("array<int>")
    return stations.withColumn("year", F.explode(years))


def with_key(units: DataFrame, ref: str = "station_ref", year: str = "year") -> DataFrame:
    return units.withColumn("unit_key", unit_key(F.col(ref), F.col(year)))


def pending(units: DataFrame, done: DataFrame, on: list[str]) -> DataFrame:
    """Units that are not in the ledger."""
    return units.join(done.select(*on).distinct(), on, "left_anti")


def additions(finished: DataFrame, done: DataFrame, on: list[str]) -> DataFrame:
    """Distinct finished units that the ledger lacks, which is what an append writes."""
    return finished.select(*on).distinct().join(done.select(*on).distinct(), on, "left_anti")


def completed_count(done: DataFrame, key: str = "unit_key") -> DataFrame:
    return done.agg(F.count_distinct(key).alias("completed"))
