"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirframe.session import Scratch


def connected(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``node`` and ``root`` (least node of its component) of all nodes with an edge ``u, v``.

    Large-star and small-star steps by turns, until neither changes the edges.
    """
    current = scratch.keep(
        edges.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(),
        f"{name}-0",
    )
    step, before = 0, None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not state[0] or tuple(state) == before:
            break
        before = tuple(state)
        both = current.select("u", "v").union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("m").alias("u"), "v").filter("u <> v").distinct()
        step += 1
        current = scratch.keep(large, f"{name}-{step}")
        # Now u < v: each v hangs its smaller neighbours, and itself, on the least of them.
        least = current.groupBy("v").agg(F.min("u").alias("m"))
        hung = current.join(least, "v")
        small = (
            hung.select(F.col("m").alias("u"), F.col("u").alias("v"))
            .union(least.select(F.col("m").alias("u"), "v"))
            .filter("u <> v")
            .distinct()
        )
        step += 1
        current = scratch.keep(small, f"{name}-{step}")
    return current.select(F.col("v").alias("node"), F.col("u").alias("root"))
