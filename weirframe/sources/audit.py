"""Constraints in force: an audit of the folders that a write touched."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirframe.operators.checks import ConstraintBreach, breaches, orphans
from weirframe.sources.schemas import TABLES, Table
from weirframe.sources.tables import PY_HOUR_FORMAT, TableStore


def _parents_of(store: TableStore, table: Table, partitions: list) -> DataFrame:
    """Rows that may be referred to from these partitions: the parent's hours of the same days."""
    parent = TABLES[table.refers[1]]
    days = [day for day in partitions if day is not None]
    hours = [datetime.datetime.combine(day, datetime.time(hour)).strftime(PY_HOUR_FORMAT) for day in days for hour in range(24)]
    return store.read(parent, hours)


def audit(store: TableStore, touched: dict[str, tuple[list, list[int] | None]]) -> None:
    """Raises ``ConstraintBreach`` if the touched folders of a table break its constraints.

    ``touched`` has the partition values and the buckets (none: all) of each table by name.
    Unique keys, required columns and the declared reference are checked, in one job.
    """
    found = []
    for name, (partitions, buckets) in touched.items():
        table = TABLES[name]
        rows = store.read(table, partitions, buckets)
        found.append(breaches(rows, name, list(table.key), list(table.required)))
        if table.refers:
            column, _, parent_key = table.refers
            lone = orphans(rows, column, _parents_of(store, table, partitions), parent_key)
            found.append(lone.select(F.concat(F.lit(f"{name}: {column} without its row: "), F.col(column).cast("string")).alias("breach")))
    if not found:
        return
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part)
    first = whole.agg(F.count(F.lit(1)).alias("n"), F.min("breach").alias("first")).first()
    if first["n"]:
        raise ConstraintBreach(f"{first['n']} breaches, the first is: {first['first']}")
