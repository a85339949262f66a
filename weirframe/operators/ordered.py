"""Previous-row logic that survives a hot key.

A plain ``lag`` over the key sorts all rows of a key in one task. Here the rows of a
key are cut into chunks that follow the order, ``lag`` runs per (key, chunk), and
only the last row of each chunk travels to the next one.

A chunk is a whole number that never decreases along the order, for instance
``chunk_of("event_id")`` or the page number of a landed document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# About the square root of 10^12 rows: a key that holds all of them has a million
# chunks of a million rows, so neither level is too large for one task.
CHUNK_WIDTH = 1 << 20


def chunk_of(order: str | Column, width: int = CHUNK_WIDTH) -> Column:
    """Chunk number of a whole-numbered order column."""
    column = F.col(order) if isinstance(order, str) else order
    return F.call_function("div", column.cast("long"), F.lit(width))


def with_previous(
    frame: DataFrame,
    keys: list[str],
    order: list[str],
    values: list[str],
    chunk: Column,
    has_previous: str = "has_previous",
    previous: str = "previous",
) -> DataFrame:
    """Adds the preceding row's ``values`` as a struct, and whether there is one."""
    # One struct as the key: structs compare null fields as equal, so the window and the
    # join below agree on one partitioning, and rows with a NULL key part link up too.
    marked = frame.withColumns({"_key": F.struct(*keys), "_chunk": chunk})
    within = Window.partitionBy("_key", "_chunk").orderBy(*order)
    row = F.struct(*values)
    local = marked.withColumns({"_rank": F.row_number().over(within), "_local": F.lag(row).over(within)})

    tails = marked.groupBy("_key", "_chunk").agg(F.max_by(row, F.struct(*order)).alias("_tail"))
    across = Window.partitionBy("_key").orderBy("_chunk")
    carried = tails.select("_key", "_chunk", F.lag("_tail").over(across).alias("_carried"))

    first = F.col("_rank") == 1
    return (
        local.join(carried.filter("_carried is not null"), ["_key", "_chunk"], "left")
        .withColumns(
            {
                has_previous: ~first | F.col("_carried").isNotNull(),
                previous: F.when(first, F.col("_carried")).otherwise(F.col("_local")),
            }
        )
        .drop("_key", "_chunk", "_rank", "_local", "_carried")
    )


def with_position(frame: DataFrame, order: str, chunk: Column, position: str = "position") -> DataFrame:
    """Adds the 0-based position in the whole frame by a unique order column.

    Ranks are taken per chunk; only the chunk counts are summed in one place, one
    small row per chunk.
    """
    marked = frame.withColumn("_chunk", chunk)
    counts = marked.groupBy("_chunk").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_chunk", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    rank = F.row_number().over(Window.partitionBy("_chunk").orderBy(order))
    return (
        marked.withColumn("_rank", rank)
        .join(offsets, "_chunk")
        .withColumn(position, F.col("_offset") + F.col("_rank") - 1)
        .drop("_chunk", "_rank", "_offset")
    )
