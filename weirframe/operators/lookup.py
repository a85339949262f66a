"""Lookup joins."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Rows that are sent whole to every executor at most.
BROADCAST_ROWS = 200_000


def size_checked(frame: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A join side that is broadcast only for what it is at run time.

    ``rows`` is the counted size of a frame that is already written. Without it the
    choice is left to Spark, which knows run-time sizes once the side is shuffled. With
    more than ``limit`` rows the side is never broadcast, however small its estimate
    (an exploded frame is estimated as if it were not exploded).
    """
    if rows is None:
        return frame
    return frame.hint("broadcast") if rows <= limit else frame.hint("merge")


def left_lookup(
    frame: DataFrame,
    table: DataFrame,
    on: dict[str, str],
    values: list[str],
) -> DataFrame:
    """Attaches ``values`` of a table that is unique on the mapped columns; a miss gives NULLs."""
    renamed = {right: f"_k_{right}" for right in on.values()}
    right = table.select(*on.values(), *[v for v in values if v not in renamed]).withColumnsRenamed(renamed)
    condition = [frame[left] == right[renamed[key]] for left, key in on.items()]
    return frame.join(right, condition, "left").drop(*renamed.values())
