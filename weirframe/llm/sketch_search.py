"""Ranked lexical search over hashed max-sketches of documents.

Terms are the maximal runs of ASCII letters, ASCII digits and characters beyond ASCII, of
which only A-Z are lower-cased. A term has the weight ``w = floor(1000 ln((2N+2)/(2df+1)))``
and in a document of ``n`` terms, where it occurs ``tf`` times, the impact
``(10**9 tf) div (1000 tf + 8m)`` with ``m = 10 + (90nN) div L``. A score is the sum of
weight times impact over a query's distinct terms.

Index. Each document's impacts are folded into a sketch: every term has two places in it,
given by its hash, and a place holds the greatest impact of the terms that fall there. A
sketch has ``PLACES`` places for each distinct term (a power of two, ``MOST_PLACES`` at most)
and keeps impacts as whole multiples of the document's ``unit``, rounded up. The lesser of a
term's two places is thus never below its impact, and the weighted sum never below the score.

Search. A task reads sketches in slices and looks up all terms of a block of queries at
once. For each query it takes documents by falling bounds and scores them exactly from their
texts, until the next bound is below the query's tenth best score so far, which it keeps from
slice to slice. So results are exact and most texts are not even split. No documents are
shuffled: a task sends its best rows of each query, and one window ranks them.

Queries are worked off in blocks of about ``BLOCK_TERMS`` (query, term) pairs, by a hash of
the query, which bounds what a task is sent. Counts of documents are made for the queries'
terms only, which tasks recognise by a bitmap of fixed size.

Nulls: a null text has no terms. Documents without terms count in nothing. A null document id
ranks behind equal scores. Rows with one query id are one query with the terms of all of
them; null ids are one query. Repeated documents are ranked each. A query whose terms occur
in no document, an empty table of queries and an empty table of documents give no rows.
Texts are taken whole, one slice of ``batches.SLICE_BYTES`` or one text at a time. Columns
other than ids and texts are ignored, whatever their names.
"""

from __future__ import annotations

from bisect import insort
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirframe.llm.batches import numbered, slices, starts_of, utf8
from weirframe.session import Scratch

BEST = 10
HASH_SEED = 42
PLACES = 4
LEAST_PLACES = 64
MOST_PLACES = 1 << 16
#: Pairs of query and term that are searched in one pass over the sketches.
BLOCK_TERMS = 1 << 16
#: Bits of the bitmap that marks terms of queries; a bitmap of Spark has 2^15.
MARK_BITS = 1 << 20
BITMAP_BITS = 1 << 15
#: Terms that a task counts before it passes their counts on.
COUNTED = 1 << 18
#: Looked-up places that a task holds at a time.
CELLS = 1 << 21

_TERM = bytes(
    (b + 32 if 0x41 <= b <= 0x5A else b) if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """Terms of UTF-8 text, in order, with repeats."""
    return text.translate(_TERM).split()


def hashes(terms: list[bytes]) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(term, HASH_SEED) for term in terms), np.uint64, len(terms))


def _split(part: pa.RecordBatch) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of a slice, terms of each row, and (row, term, tf) of every distinct pair."""
    found = [terms_of(text) for text in utf8(part, "text")]
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    distinct, number = numbered(list(chain.from_iterable(found)))
    places = np.repeat(np.arange(len(found), dtype=np.int64), sizes) * max(1, len(distinct)) + number
    pairs, tf = np.unique(places, return_counts=True)
    rows, terms = np.divmod(pairs, max(1, len(distinct)))
    return distinct, sizes, rows, terms, tf.astype(np.int64)


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Impacts of terms that occur ``tf`` times in documents of ``n`` terms."""
    m = 10 + (90 * n * n_docs) // n_terms
    return (10**9 * tf) // (1000 * tf + 8 * m)


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def query_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``query`` and ``term``, once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [list(dict.fromkeys(terms_of(text))) for text in utf8(part, "text")]
                rows = np.repeat(np.arange(len(found)), [len(one) for one in found])
                terms = pa.array([term.decode() for term in chain.from_iterable(found)], pa.string())
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(rows)), terms], ["query", "term"])

    return _source(queries, id_col, text_col).mapInArrow(run, "query long, term string").distinct()


def _marks(terms: DataFrame) -> bytes:
    """``MARK_BITS`` bits, of which those at the hashes of ``terms`` are set."""
    place = F.pmod(F.xxhash64("term"), F.lit(MARK_BITS)) + 1
    filled = (
        terms.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
        .groupBy("bucket")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .collect()
    )
    size = BITMAP_BITS // 8
    marks = bytearray(MARK_BITS // 8)
    for bucket, bits in filled:
        marks[(bucket - 1) * size : bucket * size] = bits
    return bytes(marks)


def counts(docs: DataFrame, marks: bytes) -> DataFrame:
    """Partial counts of tasks: ``term``, ``df``, and in rows without a term ``n_docs``, ``n_terms``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(marks, np.uint8), bitorder="little").astype(bool)
        held: Counter[bytes] = Counter()
        n_docs = n_terms = 0

        def emit(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
            columns = list(zip(*rows, strict=True)) or [()] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["term", "df", "n_docs", "n_terms"]
            )

        for batch in batches:
            for part in slices(batch, "text"):
                distinct, sizes, _, terms, _ = _split(part)
                n_docs += int((sizes > 0).sum())
                n_terms += int(sizes.sum())
                df = np.bincount(terms, minlength=len(distinct))
                asked = np.flatnonzero(bits[(hashes(distinct) % np.uint64(MARK_BITS)).astype(np.int64)])
                held.update(dict(zip([distinct[k] for k in asked.tolist()], df[asked].tolist(), strict=True)))
                if len(held) > COUNTED:
                    yield emit([(term.decode(), n, 0, 0) for term, n in held.items()])
                    held.clear()
        yield emit([(None, 0, n_docs, n_terms), *((term.decode(), n, 0, 0) for term, n in held.items())])

    return docs.mapInArrow(run, "term string, df long, n_docs long, n_terms long")


def fold(rows: np.ndarray, hashed: np.ndarray, found: np.ndarray, n_rows: int) -> tuple[np.ndarray, list[bytes]]:
    """Unit and sketch of each row, from the row, hash and impact of each of its distinct terms."""
    distinct = np.bincount(rows, minlength=n_rows)
    wanted = np.maximum(distinct * PLACES, LEAST_PLACES).astype(np.float64)
    widths = np.minimum(1 << np.ceil(np.log2(wanted)).astype(np.int64), MOST_PLACES)
    begins = starts_of(widths)
    most = np.zeros(n_rows, np.int64)
    np.maximum.at(most, rows, found)
    units = np.maximum(1, -(-most // 255))
    values = -(-found // units[rows])
    flat = np.zeros(int(begins[-1]), np.uint8)
    for half in (hashed, hashed >> np.uint64(32)):
        places = begins[rows] + (half & (widths[rows] - 1).astype(np.uint64)).astype(np.int64)
        np.maximum.at(flat, places, values.astype(np.uint8))
    return units, [flat[a:b].tobytes() for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True)]


def sketches(docs: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """``doc_id``, ``n``, ``unit``, ``sketch`` and ``text`` of the documents that have terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                distinct, sizes, rows, terms, tf = _split(part)
                found = impacts(tf, sizes[rows], n_docs, max(1, n_terms))
                units, made = fold(rows, hashes(distinct)[terms], found, len(sizes))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes), pa.array(units), pa.array(made, pa.binary()), part.column("text")],
                    ["doc_id", "n", "unit", "sketch", "text"],
                ).filter(pa.array(sizes > 0))

    return docs.mapInArrow(run, "doc_id long, n long, unit long, sketch binary, text string")


class Block:
    """Some queries with their weighted terms, and each one's best documents so far."""

    def __init__(self, queries: list[list[tuple[bytes, int]]], n_docs: int, n_terms: int, best: int) -> None:
        self.queries, self.n_docs, self.n_terms, self.size = queries, n_docs, n_terms, best
        flat = [pair for query in queries for pair in query]
        hashed = hashes([term for term, _ in flat])
        self.low, self.high = hashed, hashed >> np.uint64(32)
        self.weights = np.array([weight for _, weight in flat], np.int64)
        self.starts = starts_of(np.array([len(query) for query in queries], np.int64))[:-1]
        self.best: list[list[tuple[int, float, int]]] = [[] for _ in queries]

    def bounds(self, units: np.ndarray, made: list[bytes]) -> np.ndarray:
        """Upper bounds of the scores of documents (rows) for the queries (columns)."""
        out = np.zeros((len(made), len(self.queries)), np.int64)
        widths = np.fromiter(map(len, made), np.int64, len(made))
        step = max(1, CELLS // len(self.weights))
        for width in np.unique(widths).tolist():
            rows = np.flatnonzero(widths == width)
            low = (self.low & np.uint64(width - 1)).astype(np.int64)
            high = (self.high & np.uint64(width - 1)).astype(np.int64)
            for at in range(0, len(rows), step):
                some = rows[at : at + step]
                table = np.frombuffer(b"".join([made[k] for k in some.tolist()]), np.uint8).reshape(-1, width)
                least = np.minimum(table[:, low], table[:, high])
                out[some] = np.add.reduceat(least * self.weights, self.starts, axis=1) * units[some][:, None]
        return out

    def score(self, query: int, tf: dict[bytes, int], n: int) -> int:
        m8 = 8 * (10 + (90 * n * self.n_docs) // self.n_terms)
        return sum(w * ((10**9 * tf[t]) // (1000 * tf[t] + m8)) for t, w in self.queries[query] if t in tf)

    def take(self, part: pa.RecordBatch) -> int:
        """Bring a slice of the index into the best documents; the number of exact scores it took."""
        ids, sizes = part.column("doc_id").to_pylist(), part.column("n").to_pylist()
        units = part.column("unit").to_numpy(zero_copy_only=False)
        bounds = self.bounds(units, part.column("sketch").to_pylist())
        texts, scored = utf8(part, "text"), 0
        split: dict[int, Counter[bytes]] = {}
        for query, best in enumerate(self.best):
            column = bounds[:, query]
            floor = -best[-1][0] if len(best) == self.size else 1
            rows = np.flatnonzero(column >= floor)
            for row in rows[np.argsort(-column[rows], kind="stable")].tolist():
                if len(best) == self.size and column[row] < -best[-1][0]:
                    break
                if row not in split:
                    split[row] = Counter(terms_of(texts[row]))
                scored += 1
                score = self.score(query, split[row], sizes[row])
                if score > 0:
                    own = ids[row]
                    insort(best, (-score, float("inf") if own is None else own, row))
                    del best[self.size :]
        return scored


def rank(index: DataFrame, block: DataFrame, n_docs: int, n_terms: int, best: int = BEST) -> DataFrame:
    """``query, doc_id, score``: each task's best documents for the queries of ``block``, which is collected."""
    queries: dict[int | None, list[tuple[bytes, int]]] = {}
    for query, term, weight in block.select("query", "term", "weight").collect():
        queries.setdefault(query, []).append((term.encode(), weight))
    names, lists = list(queries), list(queries.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = Block(lists, n_docs, n_terms, best)
        for batch in batches:
            for part in slices(batch, "text"):
                work.take(part)
        rows = [(name, None if own == float("inf") else own, -score) for name, found in zip(names, work.best, strict=True) for score, own, _ in found]
        columns = list(zip(*rows, strict=True)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query", "doc_id", "score"])

    return index.mapInArrow(run, "query long, doc_id long, score long")


def search(
    docs: DataFrame,
    queries: DataFrame,
    scratch: Scratch,
    best: int = BEST,
    id_col: str = "doc_id",
    text_col: str = "text",
    query_id_col: str = "item_id",
    query_text_col: str = "text",
) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` of each query's ``best`` documents with a score above 0."""
    source = _source(docs, id_col, text_col)
    asked = scratch.keep(query_terms(queries, query_id_col, query_text_col), "asked")
    found = scratch.keep(
        counts(source, _marks(asked)).groupBy("term").agg(*[F.sum(c).alias(c) for c in ("df", "n_docs", "n_terms")]),
        "counts",
    )
    total = found.filter("term is null").first()
    n_docs, n_terms = (total["n_docs"], total["n_terms"]) if total else (0, 0)
    weight = F.floor(F.lit(1000.0) * F.log((F.lit(2.0) * n_docs + 2) / (F.lit(2.0) * F.col("df") + 1))).cast("long")
    weighted = asked.join(found.filter("term is not null").select("term", "df"), "term").select("query", "term", weight.alias("weight"))
    weighted = scratch.keep(weighted.filter("weight > 0"), "weighted")
    n_blocks = -(-weighted.count() // BLOCK_TERMS)
    if not n_blocks:
        made = weighted.select(F.col("query").alias("item_id"), F.lit(1).alias("rank"), F.col("query").alias("doc_id"), F.col("query").alias("score"))
        return made.limit(0)
    index = scratch.keep(sketches(source, n_docs, n_terms), "sketches")
    own = F.pmod(F.xxhash64("query"), F.lit(n_blocks))
    parts = [rank(index, weighted.filter(own == k), n_docs, n_terms, best) for k in range(n_blocks)]
    ranked = parts[0]
    for part in parts[1:]:
        ranked = ranked.union(part)
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return (
        ranked.withColumn("rank", place)
        .filter(F.col("rank") <= best)
        .select(F.col("query").alias("item_id"), "rank", "doc_id", "score")
    )


def search_sql() -> str:
    """The same ranking of ``benchmark`` over ``documents`` as DuckDB SQL."""
    split = (
        "unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
        " '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))"
    )
    return f"""
with words as (select doc_id, {split} as term from documents),
tfs as (select doc_id, term, count(*) as tf from words group by all),
sizes as (select doc_id, cast(sum(tf) as bigint) as n from tfs group by all),
totals as (select count(*) as n_docs, cast(sum(n) as bigint) as n_terms from sizes),
dfs as (select term, count(*) as df from tfs group by all),
asked as (select distinct item_id, {split} as term from benchmark),
weighted as (
  select item_id, term, cast(floor(1000 * ln((2.0::double * n_docs + 2) / (2.0::double * df + 1))) as bigint) as w
  from asked join dfs using (term), totals),
scored as (
  select item_id, doc_id,
         cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms)))) as bigint) as score
  from weighted join tfs using (term) join sizes using (doc_id), totals
  group by item_id, doc_id),
ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id) as rank, doc_id, score
  from scored where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= {BEST}
"""
