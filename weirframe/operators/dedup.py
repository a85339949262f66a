"""Keep one row per key.

All of these filter ``row_number`` to one, which Spark turns into a group limit on
both sides of the shuffle: each task sends at most one row per key, so a key that
holds a third of the table is reduced before it moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirframe.functions.scalars import all_present


def _first(frame: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return frame.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def first_wins(frame: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Earliest row per key. ``order`` must be total within a key."""
    return _first(frame, keys, [F.col(c).asc() for c in order])


def last_wins(frame: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Latest row per key; also the latest reading of a series."""
    return _first(frame, keys, [F.col(c).desc() for c in order])


def split_null_keys(frame: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a full key, rows with a null key part).

    A unique constraint treats nulls as distinct, so the second part never conflicts
    and needs no shuffle. Key columns declared non-nullable make it an empty relation.
    """
    full = all_present(keys)
    return frame.filter(full), frame.filter(~full)


def first_entries(
    frame: DataFrame,
    keys: list[str],
    order: list[str],
    values: list[str],
    where: dict[str, Column],
) -> DataFrame:
    """Earliest row per key under several conditions at once, in a single pass.

    Adds one struct column per condition (NULL where no row meets it) and
    ``<name>_entries``, the number of rows that do.
    """
    position = F.struct(*order)
    row = F.struct(*values)
    aggregates: list[Column] = []
    for name, condition in where.items():
        aggregates.append(F.min_by(F.when(condition, row), F.when(condition, position)).alias(name))
        aggregates.append(F.count_if(condition).alias(f"{name}_entries"))
    return frame.groupBy(*keys).agg(*aggregates)
