"""Keys with so many rows that one task should not hold them all.

Two mergeable sketches find and cut them, each one row per task and no shuffle of rows: the
most frequent keys by ``approx_top_k`` over key hashes, then, if a key is heavy, quantiles of
its order by a KLL sketch. A key's rows are cut where its own quantiles lie, so pieces come
out even for dense, sparse and time-based orders alike.

Bounds: of N rows, a key with more than ``HEAVY_ROWS`` rows is found unless it has fewer than
about ``N / 7500``, the error of the sketch. A piece has about ``HEAVY_ROWS / 4`` rows, or
``n / PIECES`` of a key with n rows if that is more. Rows with equal places stay together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEAVY_ROWS = 1 << 20
#: Keys that are cut at most; each of the others has a smaller share of the rows than these.
MOST_KEYS = 1000
TRACKED = 20_000
PIECES = 256
#: Accuracy of the quantiles: ranks are off by 0.1 percent or so.
SKETCH_SIZE = 4000


@dataclass(frozen=True)
class HeavyKeys:
    """Heavy keys with the places at which their rows are cut.

    ``place`` is a whole number that never decreases along the order, as fine as there is
    one: an id, a page number, microseconds. ``found`` has the key's values, then its cuts.
    """

    keys: list[str]
    place: Column
    found: list[tuple]

    def table(self, spark: SparkSession, kinds: T.StructType) -> DataFrame:
        """One row per heavy key, ``MOST_KEYS`` at most, with its cuts in ``_cuts``."""
        cuts = T.StructField("_cuts", T.ArrayType(T.LongType()))
        return spark.createDataFrame(self.found, T.StructType([*kinds.fields, cuts]))


def piece_of(place: str, cuts: str) -> Column:
    """Number of the piece: how many cuts lie before the place."""
    return F.size(F.filter(cuts, lambda cut: cut < F.col(place)))


def heavy_keys(rows: DataFrame, keys: list[str], place: Column) -> HeavyKeys:
    """Runs one job, and a second one only where there is a heavy key."""
    hashed = F.xxhash64(*keys)
    top = rows.select(hashed.alias("_h")).agg(F.expr(f"approx_top_k(_h, {MOST_KEYS}, {TRACKED})").alias("top"))
    frequent = [item["item"] for item in top.first()["top"] or [] if item["count"] > HEAVY_ROWS]
    if not frequent:
        return HeavyKeys(keys, place, [])
    grid = F.array(*[F.lit((k + 1) / PIECES) for k in range(PIECES - 1)])
    sketched = (
        rows.filter(hashed.isin(frequent))
        .select(*keys, place.cast("long").alias("_place"))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.kll_sketch_agg_bigint("_place", SKETCH_SIZE).alias("_sketch"))
        .filter(F.col("_n") > HEAVY_ROWS)
        .select(*keys, "_n", F.kll_sketch_get_quantile_bigint("_sketch", grid).alias("_grid"))
    )
    found = []
    for row in sketched.collect():
        pieces = min(PIECES, -(-row["_n"] // max(1, HEAVY_ROWS // 4)))
        cuts = {row["_grid"][k * PIECES // pieces - 1] for k in range(1, pieces)}
        found.append((*[row[key] for key in keys], sorted(cuts)))
    return HeavyKeys(keys, place, found)
