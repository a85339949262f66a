"""Rules on arrays that arrive inside one row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def head(array: Column) -> Column:
    """First element; NULL for a null or empty array."""
    return F.get(array, F.lit(0))


def first_match(array: Column, predicate: Callable[[Column], Column]) -> Column:
    """First element that satisfies the predicate, or NULL."""
    return head(F.filter(array, predicate))


def covers(array: Column, axis: Column) -> Column:
    """An absent array is fine; a present one must be at least as long as the axis."""
    return array.isNull() | (F.size(array) >= F.size(axis))


def aligned(array: Column, axis: Column) -> Column:
    """The array cut to the axis length; all NULL where it is absent."""
    return F.coalesce(
        F.slice(array, F.lit(1), F.size(axis)),
        F.array_repeat(F.lit(None), F.size(axis)),
    )


def zipped(axis: Column, axis_name: str, arrays: dict[str, Column]) -> Column:
    """Parallel arrays -> one array of structs, aligned by position with the axis."""
    columns = [axis.alias(axis_name)]
    columns += [aligned(array, axis).alias(name) for name, array in arrays.items()]
    names = [axis_name, *arrays]
    zipped_rows = F.arrays_zip(*columns)
    # arrays_zip names its fields by input; rebuild the struct with the wanted names.
    return F.transform(
        zipped_rows,
        lambda row: F.struct(*[row.getItem(name).alias(name) for name in names]),
    )
