"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Index. A vector ``o`` is taken relative to the nearest of ``CELLS`` centres ``c``, brought to
length one and rotated by a random orthogonal matrix. Its code holds the signs, one bit each,
and two correction scalars stay beside it: the length ``|o - c|`` and ``f``, the inner product
of the rotated unit vector with its signs over ``sqrt(D)``. Centres are fitted on
``SAMPLE_ROWS`` vectors, chosen by a hash; every vector is coded.

Search. A query is rotated and its components are rounded to ``PLANES`` bits, so its inner
product with a code is a sum of popcounts of packed words. Over ``f`` that is an unbiased
estimate, whose error has a standard deviation of at most
``|q| |o - c| sqrt(1/f**2 - 1) / sqrt(D - 1)``, to which that of the rounding adds; ``WIDTH``
of both bound it on either side. A vector is reranked on the original components, in double
precision, unless its upper bound is below the query's threshold: the k-th best exact score
so far, in which the ``FIRST * k`` likeliest vectors of the batch are already counted.

Shuffle. Queries are cut into blocks of ``QUERY_BYTES`` and vectors into as many segments as
make a tile for each shuffle partition. A tile holds a block and a segment: its queries are
read first, then vectors stream past them, batch by batch. So the index is copied once for
each query block, and a task holds one block and one batch, whatever the size of the table.

Nulls: vectors that are null, empty or zero, or have null or non-finite components, and rows
without an id take no part. Vectors of another length than a query's are no candidates of it.
Of several query rows with one id, the least vector is searched for. Rows with the query's
own id are no candidates; of several rows with another id, the nearest counts. Equal scores
rank by id. An empty table gives no rows. Columns other than id and vector are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirframe.llm.batches import kept_in_worker
from weirframe.session import Scratch

BEST = 20
QUERY_STEP = 20
CELLS = 16
SAMPLE_ROWS = 4096
ROUNDS = 8
SEED = 7
PLANES = 6
WIDTH = 2.0
FIRST = 4
#: Bytes of the vectors of a query block.
QUERY_BYTES = 16 << 20
#: Vectors of a segment at least.
SEGMENT_ROWS = 1024
#: Pairs of query and vector, or components of reranked pairs, that a task holds at a time.
PAIRS = 1 << 18


def rotation(dims: int) -> np.ndarray:
    """A random orthogonal matrix, the same for equal ``dims``."""

    def make() -> np.ndarray:
        q, r = np.linalg.qr(np.random.default_rng(SEED + dims).standard_normal((dims, dims)))
        return q * np.sign(np.diag(r))

    return kept_in_worker(f"rotation-{dims}", make)


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id`` and ``vector`` (doubles) of the rows that take part."""
    parts = F.col("vector")
    finite = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    source = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    known = source.filter(F.col("vec_id").isNotNull() & parts.isNotNull() & (F.size(parts) > 0))
    return known.filter(finite & F.exists(parts, lambda x: x != 0))


def fit(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Centres of each length of vectors, from ``SAMPLE_ROWS`` of them (Lloyd's rounds)."""
    rows = vectors.orderBy(F.xxhash64("vec_id", "vector"), "vec_id").limit(SAMPLE_ROWS).collect()
    by_length: dict[int, list[list[float]]] = {}
    for row in rows:
        by_length.setdefault(len(row["vector"]), []).append(row["vector"])
    centres = {}
    for dims, found in by_length.items():
        points = np.array(found)
        own = points[np.linspace(0, len(points) - 1, min(CELLS, len(points))).astype(int)]
        for _ in range(ROUNDS):
            nearest = _nearest(points, own)
            held = np.bincount(nearest, minlength=len(own))
            sums = np.zeros_like(own)
            np.add.at(sums, nearest, points)
            own = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], own)
        centres[dims] = own
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1) - 2 * (points @ centres.T), axis=1)


def _centres_of(centres: dict[int, np.ndarray], dims: int) -> np.ndarray:
    return centres.get(dims, np.zeros((1, dims)))


def pack(signs: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    words = -(-signs.shape[1] // 64)
    padded = np.zeros((len(signs), words * 64), bool)
    padded[:, : signs.shape[1]] = signs
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


def code(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cell, packed signs, length and factor ``f`` of each vector."""
    dims = points.shape[1]
    cell = _nearest(points, centres)
    rest = points - centres[cell]
    length = np.sqrt((rest**2).sum(axis=1))
    turned = (rest / np.where(length > 0, length, 1)[:, None]) @ rotation(dims).T
    factor = np.abs(turned).sum(axis=1) / np.sqrt(dims)
    return cell, pack(turned > 0), length, np.where(length > 0, factor, 1.0)


def _matrices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and matrix of the vectors of each length in a batch."""
    lists = batch.column(column)
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    begins = np.cumsum(sizes) - sizes
    for dims in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == dims)
        yield rows, flat[(begins[rows][:, None] + np.arange(dims)[None, :])]


def encode(vectors: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """The index: ``vec_id, vector, cell, code, length, factor`` of usable vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, points in _matrices(batch, "vector") if batch.num_rows else ():
                cell, words, length, factor = code(points, _centres_of(centres, points.shape[1]))
                own = batch.take(pa.array(rows))
                made = [pa.array(cell, pa.int32()), pa.array([w.tobytes() for w in words], pa.binary()), pa.array(length), pa.array(factor)]
                yield pa.RecordBatch.from_arrays([*own.columns, *made], ["vec_id", "vector", "cell", "code", "length", "factor"])

    return vectors.mapInArrow(run, "vec_id long, vector array<double>, cell int, code binary, length double, factor double")


class Queries:
    """The queries of one tile that have equal length, and their best vectors so far."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, centres: np.ndarray, best: int) -> None:
        self.ids, self.points, self.best = ids, points, best
        dims = points.shape[1]
        self.norms = np.sqrt((points**2).sum(axis=1))
        self.at_centres = points @ centres.T
        turned = points @ rotation(dims).T
        self.least = turned.min(axis=1)
        self.step = np.maximum(turned.max(axis=1) - self.least, np.finfo(float).tiny) / (2**PLANES - 1)
        levels = np.rint((turned - self.least[:, None]) / self.step[:, None]).astype(np.int64)
        self.planes = [pack((levels >> p) & 1 == 1) for p in range(PLANES)]
        self.total = self.least * dims + self.step * levels.sum(axis=1)
        self.floor = np.full(len(ids), -np.inf)
        self.rows = np.empty(0, np.int64)
        self.found = np.empty(0, np.int64)
        self.scores = np.empty(0)

    def estimates(self, some: slice, cell: np.ndarray, words: np.ndarray, length: np.ndarray, factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products of queries (rows) and coded vectors (columns), and their bounds' half widths."""
        dims = self.points.shape[1]
        dots = np.zeros((len(self.ids[some]), len(cell)), np.int32)
        for p, plane in enumerate(self.planes):
            for w in range(words.shape[1]):
                dots += np.bitwise_count(plane[some, w][:, None] & words[:, w][None, :]).astype(np.int32) << p
        ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
        signed = 2 * (self.least[some][:, None] * ones + self.step[some][:, None] * dots) - self.total[some][:, None]
        guess = self.at_centres[some][:, cell] + signed * (length / factor / np.sqrt(dims))[None, :]
        turned = np.sqrt(np.maximum(0, 1 / factor**2 - 1) / max(1, dims - 1)) * length
        rounded = length / factor / np.sqrt(12)
        width = WIDTH * (self.norms[some][:, None] * turned[None, :] + self.step[some][:, None] * rounded[None, :])
        return guess, width

    def take(self, ids: np.ndarray, points: np.ndarray, cell: np.ndarray, words: np.ndarray, length: np.ndarray, factor: np.ndarray) -> int:
        """Bring coded vectors into the best ones; the number of vectors reranked."""
        reranked = 0
        step = max(1, PAIRS // max(1, len(ids)))
        for at in range(0, len(self.ids), step):
            some = slice(at, at + step)
            guess, width = self.estimates(some, cell, words, length, factor)
            open_ = self.ids[some][:, None] != ids[None, :]
            guess = np.where(open_, guess, -np.inf)
            likely = FIRST * self.best
            if len(ids) > likely:
                # The likeliest ones first: they bring the threshold near its end.
                first = np.argpartition(guess, -likely, axis=1)[:, -likely:]
                chosen = np.zeros(guess.shape, bool)
                np.put_along_axis(chosen, first, True, axis=1)
                reranked += self._rerank(at, chosen & open_ & ~(guess + width < self.floor[some][:, None]), ids, points)
                open_ &= ~chosen
            reranked += self._rerank(at, open_ & ~(guess + width < self.floor[some][:, None]), ids, points)
        return reranked

    def _rerank(self, at: int, chosen: np.ndarray, ids: np.ndarray, points: np.ndarray) -> int:
        rows, columns = np.nonzero(chosen)
        self._merge(rows + at, ids[columns], self._exact(rows + at, points, columns))
        return len(rows)

    def _exact(self, rows: np.ndarray, points: np.ndarray, columns: np.ndarray) -> np.ndarray:
        step = max(1, PAIRS // self.points.shape[1])
        parts = [
            (self.points[rows[at : at + step]] * points[columns[at : at + step]]).sum(axis=1)
            for at in range(0, len(rows), step)
        ]
        return np.concatenate(parts) if parts else np.empty(0)

    def _merge(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        better = ~(scores < self.floor[rows])
        touched = np.unique(rows[better])
        if not len(touched):
            return
        old = np.isin(self.rows, touched)
        r = np.concatenate([self.rows[old], rows[better]])
        i = np.concatenate([self.found[old], ids[better]])
        s = np.concatenate([self.scores[old], scores[better]])
        order = np.lexsort((-s, i, r))
        r, i, s = r[order], i[order], s[order]
        first = np.ones(len(r), bool)
        first[1:] = (r[1:] != r[:-1]) | (i[1:] != i[:-1])
        r, i, s = r[first], i[first], s[first]
        order = np.lexsort((i, -s, r))
        r, i, s = r[order], i[order], s[order]
        begins = np.searchsorted(r, r, side="left")
        place = np.arange(len(r)) - begins
        keep = place < self.best
        last = place == self.best - 1
        self.floor[r[last]] = s[last]
        self.rows = np.concatenate([self.rows[~old], r[keep]])
        self.found = np.concatenate([self.found[~old], i[keep]])
        self.scores = np.concatenate([self.scores[~old], s[keep]])


def _tiles(index: DataFrame, queries: DataFrame, blocks: int, segments: int) -> DataFrame:
    """Index and queries dealt to ``blocks * segments`` tiles, queries first in each."""
    nothing = {"cell": "int", "code": "binary", "length": "double", "factor": "double"}

    def copies(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    asked = queries.select("vec_id", "vector", *[F.lit(None).cast(k).alias(n) for n, k in nothing.items()], block.alias("block"), copies(segments).alias("segment"))
    segment = F.pmod(F.monotonically_increasing_id(), F.lit(segments)).cast("int")
    held = index.withColumn("segment", segment).select("vec_id", "vector", *nothing, copies(blocks).alias("block"), "segment")
    both = asked.withColumn("kind", F.lit(0)).unionByName(held.withColumn("kind", F.lit(1)))
    tile = (F.col("block") * segments + F.col("segment")).alias("tile")
    dealt = both.select(tile, "kind", "vec_id", "vector", *nothing).repartitionById(blocks * segments, "tile")
    return dealt.sortWithinPartitions("tile", "kind")


def _search_tiles(tiles: DataFrame, centres: dict[int, np.ndarray], best: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        ready: dict[int, Queries] = {}
        tile: Any = None

        def result() -> Iterator[pa.RecordBatch]:
            for one in ready.values():
                columns = [pa.array(one.ids[one.rows]), pa.array(one.found), pa.array(one.scores)]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

        for batch in batches:
            if not batch.num_rows:
                continue
            tiles_, kinds = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("tile", "kind"))
            cuts = np.flatnonzero((np.diff(tiles_) != 0) | (np.diff(kinds) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                if tiles_[a] != tile:
                    yield from result()
                    tile, asked, ready = tiles_[a], {}, {}
                part = batch.slice(a, b - a)
                ids = part.column("vec_id").to_numpy(zero_copy_only=False)
                for rows, points in _matrices(part, "vector"):
                    dims = points.shape[1]
                    if kinds[a] == 0:
                        asked.setdefault(dims, []).append((ids[rows], points))
                        continue
                    if dims in asked:
                        held = asked.pop(dims)
                        own, vectors = (np.concatenate([x[k] for x in held]) for k in (0, 1))
                        ready[dims] = Queries(own, vectors, _centres_of(centres, dims), best)
                    if dims in ready:
                        some = part.take(pa.array(rows))
                        words = np.frombuffer(b"".join(some.column("code").to_pylist()), "<u8").reshape(len(rows), -1)
                        scalars = [some.column(n).to_numpy(zero_copy_only=False) for n in ("cell", "length", "factor")]
                        ready[dims].take(ids[rows], points, scalars[0], words, *scalars[1:])
        yield from result()

    return tiles.mapInArrow(run, "query_id long, vec_id long, score double")


def search(index: DataFrame, queries: DataFrame, centres: dict[int, np.ndarray], best: int = BEST) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the ``best`` vectors of ``index`` found for each query.

    ``index`` is what ``encode`` gives, written; ``queries`` has ``vec_id`` and ``vector``, once each.
    """
    spark = index.sparkSession
    sizes = queries.agg(F.count("*"), F.sum(F.size("vector").cast("long"))).first()
    rows = index.count()
    blocks = max(1, -(-8 * (sizes[1] or 0) // QUERY_BYTES))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    segments = max(1, min(partitions // blocks, rows // SEGMENT_ROWS))
    found = _search_tiles(_tiles(index, queries, blocks, segments), centres, best)
    distinct = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return distinct.withColumn("rank", place).filter(F.col("rank") <= best).select("query_id", "rank", "vec_id", "score")


def neighbours(
    vectors: DataFrame, scratch: Scratch, step: int = QUERY_STEP, best: int = BEST, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``search`` for every row whose id ``step`` divides, against all rows."""
    source = usable(vectors, id_col, vector_col)
    centres = fit(source)
    index = scratch.keep(encode(source, centres), "index")
    asked = index.filter(F.col("vec_id") % step == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    return search(index, scratch.keep(asked, "queries"), centres, best)
