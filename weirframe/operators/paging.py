"""Pages of a listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirframe.fixed import PAGE_SIZE


class IncompleteListing(ValueError):
    """A landed listing that misses a page or has one that cannot be read."""


def page_of(position: Column, size: int = PAGE_SIZE) -> Column:
    """Page that holds a 0-based position."""
    return F.call_function("div", position.cast("long"), F.lit(size))


def require_complete(pages: DataFrame, what: str) -> None:
    """Raises unless narrow (page, malformed) rows cover page 0 to the last one, all readable.

    No pages at all are complete. A short or empty page does not end a listing.
    """
    found = pages.groupBy("page").agg(F.bool_or("malformed").alias("malformed"))
    state = found.agg(
        F.count(F.lit(1)).alias("n"),
        F.max("page").alias("last"),
        F.count_if("malformed").alias("bad"),
        F.min(F.when(F.col("malformed"), F.col("page"))).alias("first_bad"),
    ).first()
    if state["bad"]:
        raise IncompleteListing(f"{what}: {state['bad']} malformed pages, the first is page {state['first_bad']}")
    if state["n"] and state["n"] != state["last"] + 1:
        raise IncompleteListing(f"{what}: {state['last'] + 1 - state['n']} pages are missing before page {state['last']}")
